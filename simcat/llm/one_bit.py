"""Hard-negative mining with rotated one-bit codes and exact integer scores.

Vectors become integers (``floor(256 * x)`` per component).  A random rotation turns each into
``r``; its code keeps the signs of ``r``, that is the unit vector ``u`` of entries +-1/sqrt(D).  Stored
beside the code are the alignment ``a = <r, u>`` and the length of the residual ``e = r - a * u``.
For a rotated query ``q``

    <r, q> = a * <u, q> + <e, q>   and   |<e, q>| <= |e| * sqrt(|q|^2 - <u, q>^2)

because ``e`` is orthogonal to ``u`` (Cauchy-Schwarz).  ``<u, q>`` comes from popcounts of the code with
the bit planes of the quantised query, whose own error is known exactly.  So every pair gets an
interval that holds its score for certain.  Pairs whose interval can't matter are dropped, all
others get the exact integer score; no result depends on the codes.

Anchors are taken in chunks of about ``CHUNK``, one after another: a chunk is broadcast, every row is
compared where it lies, and a task keeps the best rows per anchor.  The first pass finds each anchor's
positives, the second the negatives in the band that a positive's score sets.  Nothing is grouped by
label, so a label with a third of the rows costs no task more.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part; shorter vectors count as filled with zeros; components are held within +-2^27 after
scaling, so that scores fit 64 bits; ties go to the smaller id, then a null id, then the row's place
in the input; rows that share an id are different rows, and each with an anchor's id is an anchor; a
null id is no anchor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from simcat.llm.common import materialise, shared_path, table

SCALE = 256
LARGEST = 1 << 27
SEED = 13
CHUNK = 2048             # anchors held at once, about
ROWS = 4096              # rows compared at once
ANCHORS = 64             # anchors compared with them at once
PLANES = 7               # bits of a quantised query coordinate
SCORED = 65_536          # pairs scored at once
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90       # per cent of the positive's score
NO_ID = (1 << 63) - 1    # a null id sorts last

CODES = ("row long, vec_id long, label long, ints binary, code binary, align double, "
         "residual double, length double")
CODES_ARROW = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()),
                         ("ints", pa.binary()), ("code", pa.binary()), ("align", pa.float64()),
                         ("residual", pa.float64()), ("length", pa.float64())])
SLACK = 1e-9             # relative; covers rounding in the rotation and the sums


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def integers(lists: pa.Array, dims: int) -> np.ndarray:
    """``floor(SCALE * x)`` per component, rows filled with zeros to ``dims``."""
    lens = np.diff(lists.offsets.to_numpy())
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lists), dims))
    rows = np.repeat(np.arange(len(lists)), lens)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[rows, at] = np.clip(flat, -LARGEST, LARGEST)
    return out


def encode(ints: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """(codes as bytes, alignment, residual length, length) of integer vectors."""
    r = ints @ turn.T
    code = np.packbits(r >= 0, axis=1, bitorder="little")
    align = np.abs(r).sum(1) / math.sqrt(r.shape[1])
    length = np.sqrt((ints * ints).sum(1))
    residual = np.sqrt(np.maximum(0.0, length ** 2 - align ** 2)) + SLACK * length
    return code, align, residual, length


def planes_of(query: np.ndarray, bits: int = PLANES) -> dict:
    """Quantised rotated queries: per coordinate ``low + step * level``, the levels as bit planes;
    ``error`` bounds what a sum of signed coordinates is off."""
    low = query.min(1)
    step = np.maximum((query.max(1) - low) / ((1 << bits) - 1), 1e-30)
    level = np.rint((query - low[:, None]) / step[:, None]).clip(0, (1 << bits) - 1)
    near = low[:, None] + step[:, None] * level
    level = level.astype(np.uint8)
    words = np.stack([np.packbits((level >> b) & 1, axis=1, bitorder="little").view("<u8")
                      for b in range(bits)])
    return {"planes": words, "low": low, "step": step, "total": near.sum(1),
            "error": np.abs(query - near).sum(1)}


def intervals(q: dict, a: slice, code: np.ndarray, align: np.ndarray, residual: np.ndarray,
              length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Certain lower and upper bounds of the scores of anchors ``a`` (rows) with coded rows (columns)."""
    dims = code.shape[1] * 64
    hits = np.zeros((len(q["low"][a]), len(code)))
    for b in range(q["planes"].shape[0]):
        count = sum(np.bitwise_count(q["planes"][b, a, w][:, None] & code[None, :, w]).astype(np.int32)
                    for w in range(code.shape[1]))
        hits += count * float(1 << b)
    ones = np.bitwise_count(code).sum(1)
    signed = 2 * (q["low"][a][:, None] * ones + q["step"][a][:, None] * hits) - q["total"][a][:, None]
    along = signed / math.sqrt(dims)
    off = (q["error"][a] / math.sqrt(dims) + SLACK * q["length"][a])[:, None]
    least = np.maximum(0.0, np.abs(along) - off)
    across = np.sqrt(np.maximum(0.0, q["length"][a][:, None] ** 2 - least ** 2))
    mid = align * along
    wide = align * off + residual * across + SLACK * (1 + q["length"][a][:, None] * length)
    return mid - wide, mid + wide


def prepare(vectors: DataFrame, seed: int = SEED) -> tuple[DataFrame, int]:
    """The rows that take part, coded and written once; and the padded number of dimensions."""
    unit = F.lit(float("inf"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < unit))
    label = F.col("label").cast("long")
    rows = (vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
            .select(F.monotonically_increasing_id().alias("row"),
                    F.col("vec_id").cast("long").alias("vec_id"),
                    F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label)
                    .alias("label"), F.col("embedding").cast("array<double>").alias("embedding")))
    most = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 1
    dims = 64 * math.ceil(max(most, 1) / 64)
    turn = rotation(dims, seed)

    def run(batches):
        for batch in batches:
            ints = integers(batch.column("embedding"), dims)
            code, align, residual, length = encode(ints, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), batch.column("label"),
                 pa.array([x.tobytes() for x in ints.astype("<i4")], pa.binary()),
                 pa.array([x.tobytes() for x in code], pa.binary()), pa.array(align),
                 pa.array(residual), pa.array(length)], schema=CODES_ARROW)
    return materialise(rows.mapInArrow(run, CODES), "one-bit-codes"), dims


def arrays(batch, dims: int) -> dict:
    """Columns of ``CODES`` as arrays."""
    n = batch.num_rows
    col = lambda c: batch.column(c)
    data = lambda c: b"".join(col(c).to_pylist())
    ids = col("vec_id")
    return {"row": col("row").to_numpy(), "vec_id": ids.fill_null(NO_ID).to_numpy(),
            "label": col("label").to_numpy(),
            "ints": np.frombuffer(data("ints"), "<i4").reshape(n, dims).astype(np.int64),
            "code": np.frombuffer(data("code"), "<u8").reshape(n, dims // 64),
            "align": col("align").to_numpy(), "residual": col("residual").to_numpy(),
            "length": col("length").to_numpy()}


def anchors_of(batch, dims: int, seed: int = SEED) -> dict:
    """A chunk of anchors, ready to be broadcast: plain arrays."""
    rows = arrays(batch, dims)
    return rows | planes_of(rows["ints"].astype(np.float64) @ rotation(dims, seed).T)


def pieces(batches, dims: int, rows: int = ROWS):
    """The coded rows of a task, about ``rows`` at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield arrays(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dims)
            held, n = [], 0
    if n:
        yield arrays(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dims)


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows ``a[i]`` and ``b[j]``."""
    out = np.empty(len(i), dtype=np.int64)
    for s in range(0, len(i), SCORED):
        out[s:s + SCORED] = np.einsum("ij,ij->i", a[i[s:s + SCORED]], b[j[s:s + SCORED]])
    return out


class Best:
    """The ``k`` best rows per slot: by score, then id, then place."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = self.score = self.vec_id = self.row = np.zeros(0, np.int64)
        self.full = np.full(slots, -(1 << 62), dtype=np.int64)   # the k-th score where there are k

    def add(self, slot, score, vec_id, row) -> None:
        slot, score = np.r_[self.slot, slot], np.r_[self.score, score]
        vec_id, row = np.r_[self.vec_id, vec_id], np.r_[self.row, row]
        order = np.lexsort((row, vec_id, -score, slot))
        slot, score, vec_id, row = slot[order], score[order], vec_id[order], row[order]
        start = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, int)
        nth = np.arange(len(slot)) - np.repeat(start, np.diff(np.r_[start, len(slot)]))
        last = nth == self.k - 1
        self.full[slot[last]] = score[last]
        keep = nth < self.k
        self.slot, self.score, self.vec_id, self.row = slot[keep], score[keep], vec_id[keep], row[keep]


def positives_in(pieces_, q: dict, k: int):
    """The best ``k`` same-label rows per anchor of a task's rows: (slot, score, vec_id, row)."""
    best = Best(len(q["row"]), k)
    for x in pieces_:
        for s in range(0, len(q["row"]), ANCHORS):
            a = slice(s, s + ANCHORS)
            same = (q["label"][a][:, None] == x["label"]) & (q["row"][a][:, None] != x["row"])
            low, high = intervals(q, a, x["code"], x["align"], x["residual"], x["length"])
            least = best.full[a].astype(np.float64)
            if len(x["row"]) > k:
                low[~same] = -np.inf
                least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
            i, j = np.nonzero(same & (high >= least[:, None]))
            best.add(i + s, exact(q["ints"][a], x["ints"], i, j), x["vec_id"][j], x["row"][j])
    return best


def negatives_in(pieces_, q: dict, pairs: dict, k: int, low_pc: int, high_pc: int):
    """The best ``k`` other-label rows per (anchor, positive) whose score lies in the band."""
    best = Best(len(pairs["slot"]), k)
    # pairs are sorted by anchor: the m-th positive of every anchor, -1 where there is none
    first = np.searchsorted(pairs["slot"], np.arange(len(q["row"]) + 1))
    most = int(np.diff(first).max()) if len(first) > 1 else 0
    nth = np.stack([np.where(first[:-1] + m < first[1:], first[:-1] + m, -1) for m in range(most)]) \
        if most else np.zeros((0, len(q["row"])), int)
    lo, hi = low_pc * pairs["score"], high_pc * pairs["score"]
    for x in pieces_:
        for s in range(0, len(q["row"]), ANCHORS):
            a = slice(s, s + ANCHORS)
            other = q["label"][a][:, None] != x["label"]
            low, high = intervals(q, a, x["code"], x["align"], x["residual"], x["length"])
            wanted = np.zeros(other.shape, dtype=bool)
            for m in nth[:, a]:
                there = m >= 0
                floor = np.where(there, np.maximum(lo[m], 100 * np.maximum(best.full[m], -(1 << 55))), 0)
                wanted |= (there[:, None] & (100 * high >= floor[:, None])
                           & (100 * low <= np.where(there, hi[m], 0)[:, None]))
            i, j = np.nonzero(wanted & other)
            score = exact(q["ints"][a], x["ints"], i, j)
            found = []
            for m in nth[:, a]:
                p = m[i]
                ok = (p >= 0) & (lo[p] <= 100 * score) & (100 * score <= hi[p])
                found.append((p[ok], score[ok], x["vec_id"][j[ok]], x["row"][j[ok]]))
            if found:
                best.add(*[np.concatenate(c) for c in zip(*found)])
    return best


PARTIAL = "slot long, score long, vec_id long, row long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def emit(best: Best):
    if len(best.slot):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.score, best.vec_id,
                                                                best.row)],
                                         names=["slot", "score", "vec_id", "row"])


def ranked(partial: DataFrame, k: int) -> DataFrame:
    """The tasks' best rows brought together: ``rank`` from 1 per slot."""
    w = Window.partitionBy("slot").orderBy(F.col("score").desc(), "vec_id", "row")
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_pc: int = LOW, high_pc: int = HIGH, chunk: int = CHUNK, seed: int = SEED) -> DataFrame:
    """Hard negatives of the anchors (ids divisible by ``every``): columns of ``RESULT``."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows, dims = prepare(vectors, seed)
    anchors = rows.where(F.col("vec_id") % every == 0)
    chunks = max(1, math.ceil(anchors.count() / chunk))
    part = F.pmod(F.xxhash64("row"), F.lit(chunks))
    to = shared_path(spark, "hard-negatives")
    for c in range(chunks):
        # about ``chunk`` anchors: the hash of a unique number deals them evenly
        own = anchors.where(part == c).orderBy("row").toArrow().combine_chunks()
        if not own.num_rows:
            continue
        q = anchors_of(own.to_batches()[0], dims, seed)
        shared = sc.broadcast(q)

        def first(batches):
            yield from emit(positives_in(pieces(batches, dims), shared.value, positives))

        near = ranked(rows.mapInArrow(first, PARTIAL), positives).orderBy("slot", "rank").toPandas()
        pairs = sc.broadcast({c: near[c].to_numpy(np.int64) for c in ("slot", "score", "vec_id")})

        def second(batches):
            yield from emit(negatives_in(pieces(batches, dims), shared.value, pairs.value, negatives,
                                         low_pc, high_pc))

        found = ranked(rows.mapInArrow(second, PARTIAL), negatives)
        names = spark.createDataFrame(
            [(i, int(q["vec_id"][s]), int(v), int(p)) for i, (s, v, p) in enumerate(
                zip(near["slot"], near["vec_id"], near["score"]))],
            "slot long, anchor_id long, positive_id long, positive_score long")
        none = lambda x: F.when(x != NO_ID, x)
        (found.join(F.broadcast(names), "slot")      # at most ``positives`` rows per anchor of a chunk
         .select("anchor_id", none(F.col("positive_id")).alias("positive_id"),
                 F.col("rank").cast("int").alias("rank"), none(F.col("vec_id")).alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score"))
         .write.parquet(f"{to}/chunk-{c:06d}"))
        shared.destroy()
        pairs.destroy()
    spark.createDataFrame([], RESULT).write.parquet(f"{to}/chunk-none")
    return spark.read.schema(RESULT).parquet(f"{to}/chunk-*")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id
                                              ORDER BY score DESC, other_id) AS n
                 FROM s WHERE same) t WHERE n <= 5),
g AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other_id
                            ORDER BY s.score DESC, s.other_id) AS n
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM g WHERE n <= 10"""
