"""Top-k similarity search over sparse feature lists.

Exact search scores every (query, candidate) pair, but never as a join of rows.

* A request set (``topk``) is cut by a hash of the id into chunks of about ``block_rows`` queries.
  Each chunk is broadcast in turn and every corpus partition is scored where it lies, so the
  corpus is never exchanged; a task keeps a running best ``k`` per query of the chunk.
* The whole catalogue (``topk_self``) is reduced to its distinct feature lists and cut into a few large
  hash blocks; every pair of blocks meets once, in tiles whose score matrix serves both directions.

Blocks are keyed by a hash of the unique id, so they are balanced whatever the data's skew.  Only
ids, scores and tie-break columns leave the scoring tasks; the other result columns are joined to
the final rows.  Feature keys travel as 64-bit hashes.

Ranking order: score rounded to 6 places desc, then rating desc (missing last), then price asc
(missing last), then id asc.  The query itself is excluded; k <= 0 gives no rows; k beyond the
corpus gives every other row.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simcat.config import Config
from simcat.functions.parsers import strip


@dataclass(frozen=True)
class RankSpec:
    """How rows are identified, scored and tie-broken."""
    id_col: str = "product_id"
    id_type: str = "string"
    # (column, "desc"|"asc", fill for missing) after the rounded score
    tiebreak: tuple = (("rating", "desc", -1.0), ("sales_price", "asc", math.inf))
    # extra columns carried from the candidate into the result
    carry: tuple = ("product_name", "brand", "child_category", "sales_price", "rating", "image_url")
    keys_col: str = "fkeys"
    vals_col: str = "fvals"
    score_places: int = 6
    exclude_self: bool = True
    extra: dict = field(default_factory=dict)
    # a dense block beside the feature list (array<double>, already scaled; null counts as zeros)
    dense_col: str = ""


PRODUCT_RANK = RankSpec()


def _result_schema(spec: RankSpec) -> str:
    """Columns that a scoring task emits."""
    return ", ".join([f"query_id {spec.id_type}", f"{spec.id_col} {spec.id_type}", "score double"]
                     + [f"{c} double" for c, _, _ in spec.tiebreak])


def query_side(df: DataFrame, spec: RankSpec, *extra: str) -> DataFrame:
    """Id, hashed feature list and dense block (fresh columns, so both sides may come from one DataFrame)."""
    dense = [F.col(spec.dense_col).cast("array<double>").alias(spec.dense_col)] if spec.dense_col else []
    return df.select(F.col(spec.id_col).alias(spec.id_col),
                     F.transform(F.col(spec.keys_col), lambda k: F.xxhash64(k)).alias(spec.keys_col),
                     F.col(spec.vals_col).alias(spec.vals_col), *dense, *extra)


def candidate_side(df: DataFrame, spec: RankSpec, *extra: str) -> DataFrame:
    return query_side(df, spec, *[F.col(c).cast("double").alias(c) for c, _, _ in spec.tiebreak], *extra)


def _flat(pdf: pd.DataFrame, spec: RankSpec):
    """(row, key, value) of every feature."""
    keys, vals = pdf[spec.keys_col].values, pdf[spec.vals_col].values
    lens = np.fromiter((len(k) for k in keys), dtype=np.int64, count=len(keys))
    if lens.sum() == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return (np.repeat(np.arange(len(pdf)), lens),
            np.concatenate([np.asarray(k, dtype=np.int64) for k in keys]),
            np.concatenate([np.asarray(v, dtype=np.float64) for v in vals]))


def _dense(pdf: pd.DataFrame, vocab: np.ndarray, spec: RankSpec) -> np.ndarray:
    x = np.zeros((len(pdf), len(vocab)), dtype=np.float64)
    rows, keys, vals = _flat(pdf, spec)
    if len(keys) and len(vocab):
        cols = np.minimum(np.searchsorted(vocab, keys), len(vocab) - 1)
        m = vocab[cols] == keys
        np.add.at(x, (rows[m], cols[m]), vals[m])
    return x


def _dense_block(pdf: pd.DataFrame, spec: RankSpec) -> np.ndarray | None:
    """The dense block as one matrix; shorter and missing vectors are filled with zeros."""
    if not spec.dense_col:
        return None
    rows = pdf[spec.dense_col].values
    lens = np.fromiter((0 if v is None else len(v) for v in rows), dtype=np.int64, count=len(rows))
    width = int(lens.max()) if len(lens) else 0
    if len(lens) and (lens == width).all():
        return np.stack(rows).astype(np.float64) if width else np.zeros((len(rows), 0))
    out = np.zeros((len(rows), width))
    for i in np.flatnonzero(lens):
        out[i, :lens[i]] = rows[i]
    return out


def _dense_dot(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | float:
    """Inner products of two dense blocks (what one side lacks is zero)."""
    if a is None or b is None:
        return 0.0
    width = min(a.shape[1], b.shape[1])
    return a[:, :width] @ b[:, :width].T


def _out_columns(spec: RankSpec) -> list[str]:
    return [x.split(" ")[0] for x in _result_schema(spec).split(", ")]


def _empty(spec: RankSpec) -> pd.DataFrame:
    return pd.DataFrame({col: [] for col in _out_columns(spec)})


def _vocab(*frames: pd.DataFrame, spec: RankSpec) -> np.ndarray:
    return np.unique(np.concatenate([_flat(f, spec)[1] for f in frames]))


class Prepared:
    """A query block whose dense matrix is made once and scored against many blocks."""

    def __init__(self, q: pd.DataFrame, spec: RankSpec):
        self.q, self.spec = q, spec
        self.vocab = _vocab(q, spec=spec)
        self.x = _dense(q, self.vocab, spec)
        self.block = _dense_block(q, spec)

    def topk(self, c: pd.DataFrame, k: int, rows: np.ndarray | None = None) -> pd.DataFrame:
        """Best ``k`` of ``c`` for the queries at ``rows`` (all without)."""
        q, x = (self.q, self.x) if rows is None else (self.q.iloc[rows], self.x[rows])
        if q.empty or c.empty or k <= 0:
            return _empty(self.spec)
        block = self.block if rows is None or self.block is None else self.block[rows]
        r = x @ _dense(c, self.vocab, self.spec).T + _dense_dot(block, _dense_block(c, self.spec))
        r = np.round(r, self.spec.score_places)
        return select_topk(r, q, c, k, self.spec)


def select_topk(r: np.ndarray, q: pd.DataFrame, c: pd.DataFrame, k: int,
                spec: RankSpec, names: np.ndarray | None = None) -> pd.DataFrame:
    """Best ``k`` columns of the rounded score matrix ``r`` (queries x candidates) per row.

    ``names`` stand in ``query_id``; without them the queries' own ids do.
    """
    r = r.copy()
    qid = q[spec.id_col].to_numpy()
    cid = c[spec.id_col].to_numpy()
    if spec.exclude_self:
        # position of each query inside this candidate block (ids are unique)
        own = pd.Index(cid).get_indexer(qid)
        hit = own >= 0
        r[np.flatnonzero(hit), own[hit]] = -np.inf
    kk = min(k, r.shape[1])
    thr = -np.partition(-r, kk - 1, axis=1)[:, kk - 1]
    qi, ci = np.nonzero((r >= thr[:, None]) & np.isfinite(r))
    score = r[qi, ci]
    # lexsort: last key is primary
    keys = []
    _, id_rank = np.unique(cid.astype(object), return_inverse=True)
    keys.append(id_rank[ci])
    for col, order, fill in reversed(spec.tiebreak):
        v = c[col].to_numpy(dtype=np.float64)[ci]
        v = np.where(np.isnan(v), fill, v)
        keys.append(-v if order == "desc" else v)
    keys.append(-score)
    keys.append(qi)
    order = np.lexsort(keys)
    qi, ci, score = qi[order], ci[order], score[order]
    first = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
    starts = np.repeat(first, np.diff(np.r_[first, len(qi)]))
    keep = (np.arange(len(qi)) - starts) < k
    qi, ci, score = qi[keep], ci[keep], score[keep]
    cols = _out_columns(spec)
    res = {"query_id": (qid if names is None else names)[qi], spec.id_col: cid[ci], "score": score}
    for col in cols[3:]:
        res[col] = c[col].to_numpy()[ci]
    return pd.DataFrame(res)[cols]


TILE = 1024              # rows of a score matrix's side
SPARSE = 8               # lists with fewer than 1/SPARSE of a tile's keys are not multiplied as matrices


class Block:
    """Rows in ranking order of their tie-break (a row's place is its rank), feature lists as flat arrays."""

    def __init__(self, pdf: pd.DataFrame, spec: RankSpec, ordered: bool = True):
        self.spec = spec
        self.pdf = pdf.iloc[tiebreak_order(pdf, spec)].reset_index(drop=True) if ordered else pdf
        rows, self.keys, self.vals = _flat(self.pdf, spec)
        self.start = np.r_[0, np.cumsum(np.bincount(rows, minlength=len(self.pdf)))]
        self.dense = _dense_block(self.pdf, spec)

    def __len__(self) -> int:
        return len(self.pdf)

    def tiles(self, tile: int = TILE) -> list[tuple[int, int]]:
        return [(a, min(a + tile, len(self))) for a in range(0, len(self), tile)]


class Tile:
    """Rows ``lo`` to ``hi`` of a block as a matrix over their own keys, to be multiplied with other rows."""

    def __init__(self, block: Block, lo: int, hi: int):
        keys, vals = (x[block.start[lo]:block.start[hi]] for x in (block.keys, block.vals))
        self.vocab, cols = np.unique(keys, return_inverse=True)
        self.xt = np.zeros((len(self.vocab), hi - lo))
        rows = np.repeat(np.arange(hi - lo), np.diff(block.start[lo:hi + 1]))
        np.add.at(self.xt.ravel(), cols * (hi - lo) + rows, vals)
        self.dense = None if block.dense is None else block.dense[lo:hi]

    def known(self, other: Block, lo: int = 0, hi: int | None = None):
        """The features of ``other``'s rows that this tile has too: (start of each row, column, value)."""
        hi = len(other) if hi is None else hi
        keys, vals = (x[other.start[lo]:other.start[hi]] for x in (other.keys, other.vals))
        if not len(self.vocab) or not len(keys):
            return np.zeros(hi - lo + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.vocab, keys), len(self.vocab) - 1)
        same = self.vocab[at] == keys
        return np.r_[0, np.cumsum(same)][other.start[lo:hi + 1] - other.start[lo]], at[same], vals[same]

    def scores(self, other: Block, lo: int, hi: int) -> np.ndarray:
        """Inner products of ``other``'s rows ``lo`` to ``hi`` with the tile's rows: others x own."""
        start, cols, vals = self.known(other, lo, hi)
        out = np.zeros((hi - lo, self.xt.shape[1]))
        if len(vals) * SPARSE >= len(self.vocab) * (hi - lo):
            x = np.zeros((hi - lo, len(self.vocab)))
            np.add.at(x.ravel(), np.repeat(np.arange(hi - lo), np.diff(start)) * len(self.vocab) + cols, vals)
            np.matmul(x, self.xt, out=out)
        else:
            for i, (a, b) in enumerate(zip(start[:-1].tolist(), start[1:].tolist())):
                if b > a:
                    np.dot(vals[a:b], self.xt[cols[a:b]], out=out[i])
        if self.dense is not None:
            out += _dense_dot(other.dense[lo:hi], self.dense)
        if not np.isfinite(out.sum()):
            out[~np.isfinite(out)] = -np.inf
        return out


class Best:
    """The best ``k`` others of each of ``n`` rows, by (rounded score, place).

    Others must be added in the order of their places, so a later one enters a full list only with a larger score.
    ``floor`` holds scores that an entry must have at least.
    """

    def __init__(self, n: int, k: int, spec: RankSpec, floor: np.ndarray | None = None):
        self.k, self.places, self.step = k, spec.score_places, 10.0 ** -spec.score_places
        self.score, self.place = np.full((n, k), -np.inf), np.full((n, k), -1, dtype=np.int64)
        self.floor = floor

    def add(self, lo: int, hi: int, m: np.ndarray, first: int, own: bool = False) -> None:
        """Scores ``m`` of the rows ``lo`` to ``hi`` (rows x others), the others' places from ``first``;
        with ``own`` these are the same rows, and no row meets itself."""
        if own:
            m = m.copy()
            np.fill_diagonal(m, -np.inf)
        least = self.score[lo:hi, -1]
        # what rounds to more than the last of a full list, or to the floor at least
        bar = least + self.step * 0.4999
        if self.floor is not None:
            bar = np.maximum(bar, self.floor[lo:hi] - self.step * 0.5001)
        if np.isneginf(bar).any():
            i, j = np.nonzero(self._first(np.round(m, self.places)))
        elif m.flags.c_contiguous:
            i, j = np.nonzero(m > bar[:, None])
        else:
            j, i = np.nonzero(m.T > bar[None, :])
        s = np.round(m[i, j], self.places)
        keep = s > least[i]
        if self.floor is not None:
            keep &= s >= self.floor[lo:hi][i]
        i, j, s = i[keep], j[keep], s[keep]
        if not len(i):
            return
        some, i = np.unique(i, return_inverse=True)
        rows = some + lo
        held = np.arange(len(some)).repeat(self.k)
        who = np.r_[held, i]
        score = np.r_[self.score[rows].ravel(), s]
        place = np.r_[self.place[rows].ravel(), j + first]
        order = np.lexsort((place, -score, who))
        who, score, place = who[order], score[order], place[order]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        top = nth < self.k
        self.score[rows], self.place[rows] = score[top].reshape(-1, self.k), place[top].reshape(-1, self.k)

    def _first(self, r: np.ndarray) -> np.ndarray:
        """Which are the first ``k`` of their row by (score, column)."""
        kk = min(self.k, r.shape[1])
        least = np.partition(r, r.shape[1] - kk, axis=1)[:, r.shape[1] - kk, None]
        more = r > least
        tie = r == least
        return more | (tie & (np.cumsum(tie, axis=1) <= kk - more.sum(axis=1, keepdims=True)))

    def frame(self, own: pd.DataFrame, other: pd.DataFrame, spec: RankSpec) -> pd.DataFrame:
        i, n = np.nonzero(np.isfinite(self.score))
        j = self.place[i, n]
        out = {"query_id": own[spec.id_col].to_numpy()[i], spec.id_col: other[spec.id_col].to_numpy()[j],
               "score": self.score[i, n]}
        return pd.DataFrame(out | {c: other[c].to_numpy()[j] for c, _, _ in spec.tiebreak})


def tiebreak_order(pdf: pd.DataFrame, spec: RankSpec) -> np.ndarray:
    """Rows in ranking order among equal scores."""
    keys = [np.unique(pdf[spec.id_col].to_numpy().astype(object), return_inverse=True)[1]]
    for col, order, fill in reversed(spec.tiebreak):
        v = pdf[col].to_numpy(dtype=np.float64)
        v = np.where(np.isnan(v), fill, v)
        keys.append(-v if order == "desc" else v)
    return np.lexsort(keys)


def pair_topk(a: pd.DataFrame, b: pd.DataFrame | None, k: int, spec: RankSpec) -> pd.DataFrame:
    """Both directions of one block pair, tile by tile: each score matrix serves both (scores are symmetric).

    ``b=None`` is a diagonal pair (a block against itself).
    """
    if a.empty or k <= 0:
        return _empty(spec)
    own = spec.exclude_self
    x = Block(a, spec)
    if b is None or b.empty:
        to_x = Best(len(x), min(k, len(x)), spec)
        for lo, hi in x.tiles():
            tile = Tile(x, lo, hi)
            for at, end in x.tiles():
                if at >= lo:
                    m = tile.scores(x, at, end)
                    to_x.add(lo, hi, m.T, at, own and at == lo)
                    if at > lo:
                        to_x.add(at, end, m, lo)
        return to_x.frame(x.pdf, x.pdf, spec)
    y = Block(b, spec)
    to_x, to_y = Best(len(x), min(k, len(y)), spec), Best(len(y), min(k, len(x)), spec)
    for lo, hi in x.tiles():
        tile = Tile(x, lo, hi)
        for at, end in y.tiles():
            m = tile.scores(y, at, end)
            to_x.add(lo, hi, m.T, at)
            to_y.add(at, end, m, lo)
    return pd.concat([to_x.frame(x.pdf, y.pdf, spec), to_y.frame(y.pdf, x.pdf, spec)], ignore_index=True)


def merge_topk(a: pd.DataFrame, b: pd.DataFrame, k: int, spec: RankSpec) -> pd.DataFrame:
    """Best ``k`` rows per query of two partial results, under the ranking order."""
    both = pd.concat([a, b], ignore_index=True)
    keys = []
    _, id_rank = np.unique(both[spec.id_col].to_numpy().astype(object), return_inverse=True)
    keys.append(id_rank)
    for col, order, fill in reversed(spec.tiebreak):
        v = both[col].to_numpy(dtype=np.float64)
        v = np.where(np.isnan(v), fill, v)
        keys.append(-v if order == "desc" else v)
    keys.append(-both["score"].to_numpy(dtype=np.float64))
    _, q_rank = np.unique(both["query_id"].to_numpy().astype(object), return_inverse=True)
    keys.append(q_rank)
    both = both.iloc[np.lexsort(keys)]
    return both[both.groupby("query_id", sort=False).cumcount() < k]


def _block_of(id_col: str, n_blocks: int):
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_blocks)).cast("int")


def n_blocks_for(n_rows: int, block_rows: int) -> int:
    return max(1, math.ceil(n_rows / max(1, block_rows)))


BLOCK_ROWS = 2048
SCAN_BLOCKS = 16         # blocks of a corpus scored at once, in ranking order
SHIP_ROWS = 1 << 16      # rows of a block of the whole catalogue, at most


def no_result(corpus: DataFrame, spec: RankSpec) -> DataFrame:
    return with_columns(corpus.sparkSession.createDataFrame([], _result_schema(spec))
                        .withColumn("rank", F.lit(1).cast("bigint")), corpus, spec)


def query_chunks(queries: DataFrame, spec: RankSpec, block_rows: int = BLOCK_ROWS):
    """The queries in hash chunks of about ``block_rows`` rows, one at a time on the driver."""
    n = queries.count()
    chunks = n_blocks_for(n, block_rows)
    for j in range(chunks if n else 0):
        part = queries if chunks == 1 else queries.where(_block_of(spec.id_col, chunks) == j)
        yield part.toPandas()


def in_chunks(queries: DataFrame, key: str, finish, block_rows: int = BLOCK_ROWS) -> DataFrame | None:
    """``finish`` of each chunk of about ``block_rows`` queries (broadcast as pandas), put together.

    A single chunk stays lazy.  Of several, one is broadcast, scored, written to the checkpoint
    folder and freed before the next is read, so neither the driver nor the executors ever hold
    more than one.  None if there are no queries.
    """
    from simcat.session import materialise
    sc = queries.sparkSession.sparkContext
    queries = materialise(queries)       # looked up once, however many chunks follow
    n = queries.count()
    chunks = n_blocks_for(n, block_rows)
    parts = []
    for j in range(chunks if n else 0):
        part = queries if chunks == 1 else queries.where(_block_of(key, chunks) == j)
        shared = sc.broadcast(part.toPandas())
        out = finish(shared)
        if chunks > 1:
            out = materialise(out)
            shared.destroy()
        parts.append(out)
    return union_all(parts) if parts else None


def _gathered(batches, rows: int):
    """Batches put together to about ``rows`` rows."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def scan(batches, queries: pd.DataFrame, k: int, spec: RankSpec, block_rows: int = BLOCK_ROWS):
    """Best ``k`` of all rows of ``batches`` for each of ``queries``, by exact scores; one frame, if any."""
    q, best = Block(queries, spec, ordered=False), None
    tiles = [(lo, hi, Tile(q, lo, hi)) for lo, hi in q.tiles()]
    more = k + 1 if spec.exclude_self else k      # the query itself may be among the best
    for pdf in _gathered(batches, SCAN_BLOCKS * block_rows):
        c, floor = Block(pdf, spec), None
        if best is not None:
            full = best.groupby("query_id")["score"].agg(["min", "size"])
            floor = full["min"].where(full["size"] >= k).reindex(queries[spec.id_col]).fillna(-np.inf).to_numpy()
        found = Best(len(q), min(more, len(c)), spec, floor)
        for lo, hi, tile in tiles:
            for at, end in c.tiles():
                found.add(lo, hi, tile.scores(c, at, end).T, at)
        part = found.frame(q.pdf, c.pdf, spec)
        if spec.exclude_self:
            part = part[~((part["query_id"] == part[spec.id_col])
                          | (part["query_id"].isna() & part[spec.id_col].isna()))]
        best = part if best is None else merge_topk(best, part, k, spec)
    if best is not None and len(best):
        yield best


def topk(queries: DataFrame, corpus: DataFrame, k: int, spec: RankSpec = PRODUCT_RANK,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact top-k of ``corpus`` rows for every row of ``queries`` (both carry feature lists).

    Returns (query_id, rank, id, score, carried columns), ``rank`` from 1.
    """
    if k <= 0:
        return no_result(corpus, spec)
    cand = candidate_side(corpus, spec)

    def finish(shared):
        def score(batches):
            return scan(batches, shared.value, k, spec, block_rows)
        return rank_final(cand.mapInPandas(score, _result_schema(spec)), k, spec)
    ranked = in_chunks(query_side(queries, spec), spec.id_col, finish, block_rows)
    return no_result(corpus, spec) if ranked is None else with_columns(ranked, corpus, spec)


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def topk_self(features: DataFrame, k: int, spec: RankSpec = PRODUCT_RANK,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact top-k of every row against all others (whole catalogue).

    Rows with equal feature lists score alike with all others, so each distinct list is scored once, for its first
    row by the tie-break; the first ``k + 1`` rows of a list stand for the rest as neighbours.

    The lists are cut into g hash blocks; one of block b joins the g groups (min(b, j), max(b, j)), so
    only block pairs i <= j are scored and each pair's score matrix serves both directions:
    g(g+1)/2 tasks instead of g^2, and each list is shipped g times instead of 2g.  A block has up to
    ``SHIP_ROWS`` rows and is scored in tiles of ``TILE``, so g stays small.
    """
    from simcat.session import materialise
    if k <= 0:
        return no_result(features, spec)
    lists = [spec.keys_col, spec.vals_col, *([spec.dense_col] if spec.dense_col else [])]
    more = k + 1 if spec.exclude_self else k      # a row itself may be among the best of its list
    own = Window.partitionBy(*lists).orderBy(*order_columns(spec)[1:])
    heads = materialise(candidate_side(features, spec).withColumn("_n", F.row_number().over(own))
                        .where(F.col("_n") <= more))
    cells = [spec.id_col, *[c for c, _, _ in spec.tiebreak]]
    leads = heads.where(F.col("_n") == 1).drop("_n")
    n = leads.agg(F.count("*").alias("lists"), F.count(spec.id_col).alias("ids"),
                  F.count_distinct(spec.id_col).alias("different")).first()
    if n["different"] < n["ids"]:
        raise ValueError(f"{spec.id_col} names several rows with different feature lists")
    ranked = rank_final(_lists_topk(leads, more, replace(spec, exclude_self=False), block_rows), more, spec)
    ranked = ranked.select(F.col("query_id").alias("_of"), F.col(spec.id_col).alias("_lead"), "score")
    if n["lists"] == features.count():             # no list comes twice
        best = ranked.select(F.col("_of").alias("query_id"), F.col("_lead").alias(spec.id_col), "score").join(
            heads.select(*cells), spec.id_col)
    else:
        named = leads.select(*lists, F.col(spec.id_col).alias("_lead"))
        same = lambda a, b: _all_of([F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in lists])
        heads = heads.alias("h").join(named.alias("l"), same("h", "l")).select(
            "_lead", *[F.col(f"h.{c}").alias(c) for c in cells])
        # the best rows of a list are among the heads of its best lists
        top = Window.partitionBy("_of").orderBy(*order_columns(spec))
        near = (ranked.join(heads, "_lead").withColumn("_n", F.row_number().over(top))
                .where(F.col("_n") <= more).drop("_n", "_lead"))
        members = candidate_side(features, spec).select(*lists, F.col(spec.id_col).alias("query_id")).alias("m")
        named = named.withColumnRenamed("_lead", "_of").alias("l")
        best = members.join(named, same("m", "l")).select("_of", "query_id").join(near, "_of").drop("_of")
    if spec.exclude_self:
        best = best.where(~F.col("query_id").eqNullSafe(F.col(spec.id_col)))
    return with_columns(rank_final(best, k, spec), features, spec)


def _all_of(conditions):
    return functools.reduce(lambda a, b: a & b, conditions)


def _lists_topk(rows: DataFrame, k: int, spec: RankSpec, block_rows: int) -> DataFrame:
    """Best ``k`` rows of every block pair for the rows of either block."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    # few large blocks ship each row a few times; several pairs for each core
    g = max(n_blocks_for(n, SHIP_ROWS), min(n_blocks_for(n, block_rows), math.ceil(math.sqrt(6 * cores))))
    cut = (rows.withColumn("_b", _block_of(spec.id_col, g))
           .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
           .withColumn("_lo", F.least("_b", "_j")).withColumn("_hi", F.greatest("_b", "_j"))
           .drop("_j"))

    def score(key, pdf):
        lo, hi = int(key[0]), int(key[1])
        body = pdf.drop(columns=["_lo", "_hi"])
        if lo == hi:
            return pair_topk(body.drop(columns=["_b"]), None, k, spec)
        a = body[body["_b"] == lo].drop(columns=["_b"])
        b = body[body["_b"] == hi].drop(columns=["_b"])
        if a.empty or b.empty:
            return _empty(spec)
        return pair_topk(a, b, k, spec)
    return cut.groupBy("_lo", "_hi").applyInPandas(score, _result_schema(spec))


all_pairs = topk_self


def order_columns(spec: RankSpec):
    cols = [F.col("score").desc()]
    for col, order, fill in spec.tiebreak:
        v = F.coalesce(F.col(col).cast("double"), F.lit(float(fill)))
        cols.append(v.desc() if order == "desc" else v.asc())
    cols.append(F.col(spec.id_col).asc())
    return cols


def rank_final(partial: DataFrame, k: int, spec: RankSpec) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(*order_columns(spec))
    return partial.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def with_columns(ranked: DataFrame, corpus: DataFrame, spec: RankSpec) -> DataFrame:
    """The final rows with the candidates' carried and tie-break columns."""
    show = list(dict.fromkeys([c for c in spec.carry if c != spec.id_col]
                              + [c for c, _, _ in spec.tiebreak]))
    own = corpus.select(F.col(spec.id_col).alias(spec.id_col), *[F.col(c).alias(c) for c in show])
    return (ranked.select("query_id", "rank", spec.id_col, "score").join(own, spec.id_col)
            .select("query_id", "rank", spec.id_col, "score", *show))


def lookup(features: DataFrame, ids: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Rows of ``features`` whose id is in ``ids`` (trimmed), as a left-semi join."""
    wanted = ids.select(strip(F.col(ids.columns[0])).alias(id_col)).distinct()
    return features.join(wanted, id_col, "left_semi")


def unknown_ids(features: DataFrame, ids: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Requested ids (trimmed) that are not in ``features`` (left-anti join)."""
    wanted = ids.select(strip(F.col(ids.columns[0])).alias(id_col)).distinct()
    return wanted.join(features.select(id_col), id_col, "left_anti")


def similar(features: DataFrame, query_ids: DataFrame, k: int = 10, spec: RankSpec = PRODUCT_RANK,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top-k similar products for each requested id (unknown ids give no rows;
    see ``unknown_ids``)."""
    queries = lookup(features, query_ids, spec.id_col)
    return topk(queries, features, k, spec, block_rows)


def similar_one(features: DataFrame, product_id: str, k: int = 10,
                spec: RankSpec = PRODUCT_RANK) -> DataFrame:
    """Single-id form: raises KeyError for an unknown id, like the original lookup."""
    spark = features.sparkSession
    pid = product_id.strip()
    if features.where(F.col(spec.id_col) == pid).limit(1).count() == 0:
        raise KeyError(pid)
    ids = spark.createDataFrame([(pid,)], f"{spec.id_col} string")
    return similar(features, ids, k, spec)


BACKENDS = ("exact", "ann")


def validate_request(k: int, backend: str, max_k: int = 100) -> None:
    """Request rules of the lookup service: 1 <= k <= max_k and a known backend."""
    if backend not in BACKENDS:
        raise ValueError(f"backend {backend!r} is not among {BACKENDS}")
    if not 1 <= k <= max_k:
        raise ValueError(f"asked for {k} products; 1 to {max_k} can be returned")


def search(features: DataFrame, query_ids: DataFrame, k: int = 10, backend: str = "exact",
           ann_index=None, nprobe: int = Config.ann_nprobe, spec: RankSpec = PRODUCT_RANK,
           max_k: int | None = 100) -> DataFrame:
    """Top-k for the requested ids with the chosen backend.

    ``backend="ann"`` without an index falls back to exact search.  ``max_k=None``
    lifts the service's k range (the core accepts any k; k <= 0 gives no rows).
    """
    if max_k is not None:
        validate_request(k, backend, max_k)
    elif backend not in BACKENDS:
        raise ValueError(f"backend {backend!r} is not among {BACKENDS}")
    if backend == "ann" and ann_index is not None:
        from simcat.operators import ann as A
        return A.search(lookup(features, query_ids, spec.id_col), ann_index, k, nprobe)
    return similar(features, query_ids, k, spec)


def find_similar_products(features: DataFrame, product_id: str, num_similar: int = 10,
                          max_k: int = 100) -> list[str]:
    """Ids of the most similar products, best first (at most ``max_k`` reach the driver)."""
    validate_request(num_similar, "exact", max_k)
    rows = similar_one(features, product_id, num_similar).select("rank", "product_id").collect()
    return [r["product_id"] for r in sorted(rows, key=lambda r: r["rank"])]


def ids_only(results: DataFrame, id_col: str = "product_id") -> DataFrame:
    """(query_id, ids array ordered by rank)."""
    return results.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", id_col))),
                    lambda s: s[id_col]).alias("ids"))
