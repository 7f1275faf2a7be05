"""Ranked lexical search: hybrid term-at-a-time and document-at-a-time over a blocked inverted index.

``build`` writes the index: every task cuts its documents into blocks of about ``BLOCK_TERMS`` term
occurrences and writes one row per block, with the block's terms, their posting lists (document
number in the block and count), and for long lists the largest count and the shortest document of
each run of ``RUN`` documents.  No exchange is needed, whatever the skew of terms or sources.

``search`` takes the items in chunks of bounded size.  Document frequencies are added up over the
blocks; then every block answers every item where it lies:

* lists shorter than a ``LONG``-th of the block are summed term at a time into one accumulator array;
* the accumulators then act as one more list, bounded in each run by the run's largest sum, beside the
  long lists, bounded by the score of their largest count in the shortest document;
* runs are visited best bound first and read document at a time; the visit ends at the first run
  whose bound is below the item's ``k``-th score, so most postings of long lists are never scored.

A task keeps the best ``k`` per item over its blocks; the tasks' rows are ranked at the end.

Defined results: null and empty texts have no terms and rank nowhere, but take part as rows; a null
``doc_id`` sorts last among equal scores; repeated rows are different documents; every benchmark row
is an item of its own, also with a null or repeated id; other columns are ignored; a text of any
length is one document of one block, and an item of any length is whole in one chunk.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from simcat.llm.common import materialise, shared_path, small_batches, table

# Lower-case a-z, digits and every byte of a code point beyond ASCII: on UTF-8 bytes this is
# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ after lower-casing A-Z.
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+")

K = 10
BLOCK_TERMS = 2_000_000   # occurrences of one block, about
BLOCK_DOCS = 32_768       # documents of one block, at most
RUN = 64                  # documents of one run
LONG = 16                 # a list is long from one posting in so many documents on
CHUNK_BYTES = 4_000_000   # text of the items that are broadcast at once, about

B = 100 - 90              # weights of the length norm, in per cent
SLOPE = 90

BLOCK_SCHEMA = ("n_docs int, n_filled long, n_terms long, doc_ids binary, null_ids binary, "
                "lengths binary, terms binary, counts binary, docs binary, tfs binary, "
                "long_lists binary, run_tf binary, run_length binary")
NAMES = [x.split(" ")[0] for x in BLOCK_SCHEMA.split(", ")]
BLOCK_ARROW = pa.schema([("n_docs", pa.int32()), ("n_filled", pa.int64()), ("n_terms", pa.int64())]
                        + [(n, pa.binary()) for n in NAMES[3:]])


def terms_of(text: bytes) -> list[bytes]:
    return TERMS.findall(text.lower())      # bytes.lower() changes A-Z only


class Builder:
    """Collects documents and turns them into one block."""

    def __init__(self):
        self.numbers = defaultdict(itertools.count().__next__)
        self.ids, self.codes, self.size = [], [], 0

    def add(self, doc_id, text: bytes | None) -> None:
        found = terms_of(text) if text else []
        self.ids.append(doc_id)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found)))
        self.size += len(found)

    def block(self) -> dict:
        n = len(self.ids)
        lengths = np.fromiter(map(len, self.codes), np.int64, n)
        words = sorted(self.numbers)
        place = np.empty(len(words), np.int64)       # a term's place in sorted order
        place[[self.numbers[w] for w in words]] = np.arange(len(words))
        codes = place[np.concatenate(self.codes)] if self.size else np.zeros(0, np.int64)
        keys, tfs = np.unique(codes * n + np.repeat(np.arange(n), lengths), return_counts=True)
        term, doc = np.divmod(keys, max(n, 1))
        counts = np.bincount(term, minlength=len(words))
        # for long lists: the largest count and the shortest document of each run
        runs = -(-n // RUN)
        big = np.flatnonzero(counts * LONG >= n)
        row = np.full(len(words), -1)
        row[big] = np.arange(len(big))
        mine = row[term] >= 0
        cell = row[term[mine]] * runs + doc[mine] // RUN
        run_tf = np.zeros(len(big) * runs, "<u4")
        np.maximum.at(run_tf, cell, tfs[mine].astype("<u4"))
        run_length = np.full(len(big) * runs, 0xFFFFFFFF, "<u4")
        np.minimum.at(run_length, cell, np.minimum(lengths[doc[mine]], 0xFFFFFFFF).astype("<u4"))
        run_length[run_tf == 0] = 0
        null = [i for i, x in enumerate(self.ids) if x is None]
        return {"n_docs": n, "n_filled": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
                "doc_ids": np.array([x or 0 for x in self.ids], "<i8").tobytes(),
                "null_ids": np.array(null, "<u4").tobytes(), "lengths": lengths.astype("<i8").tobytes(),
                "terms": b"\n".join(words), "counts": counts.astype("<u4").tobytes(),
                "docs": doc.astype("<u2").tobytes(), "tfs": tfs.astype("<u4").tobytes(),
                "long_lists": big.astype("<u4").tobytes(), "run_tf": run_tf.tobytes(),
                "run_length": run_length.tobytes()}


def build(docs: DataFrame, path: str, text: str = "text") -> None:
    """Write the index of ``docs`` (``doc_id`` and ``text``) to ``path``."""
    small_batches(docs.sparkSession)

    def run(batches):
        held = Builder()
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.add(doc_id, data.as_py())
                if held.size >= BLOCK_TERMS or len(held.ids) >= BLOCK_DOCS:
                    yield pa.RecordBatch.from_pylist([held.block()], schema=BLOCK_ARROW)
                    held = Builder()
        if held.ids:
            yield pa.RecordBatch.from_pylist([held.block()], schema=BLOCK_ARROW)

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
     .mapInArrow(run, BLOCK_SCHEMA).write.parquet(path))


def wanted_terms(words: bytes, vocabulary: dict) -> dict[int, bytes]:
    """Number in the block -> term, for the terms of a block that are asked for."""
    if not words:
        return {}
    return {i: t for i, t in enumerate(words.split(b"\n")) if t in vocabulary}


class Block:
    """The lists of one block that the items of a chunk ask for."""

    def __init__(self, row: dict, weights: dict, n_docs: int, n_terms: int):
        part = lambda name, kind: np.frombuffer(row[name], kind)
        self.n = row["n_docs"]
        self.ids = part("doc_ids", "<i8").tolist()
        for i in part("null_ids", "<u4"):
            self.ids[i] = None
        self.runs = -(-self.n // RUN)
        self.norm = lambda length: B + (SLOPE * length.astype(np.int64) * n_docs) // n_terms
        self.m = 8 * self.norm(part("lengths", "<i8"))
        counts = part("counts", "<u4").astype(np.int64)
        ends = np.cumsum(counts)
        docs, tfs = part("docs", "<u2"), part("tfs", "<u4")
        long_at = {int(t): i for i, t in enumerate(part("long_lists", "<u4"))}
        run_tf = part("run_tf", "<u4").reshape(len(long_at), self.runs)
        run_length = part("run_length", "<u4").reshape(len(long_at), self.runs)
        self.short, self.long = {}, {}
        for i, term in wanted_terms(row["terms"], weights).items():
            w = weights[term]
            if not w:
                continue
            d = docs[ends[i] - counts[i]:ends[i]].astype(np.int64)
            tf = tfs[ends[i] - counts[i]:ends[i]].astype(np.int64)
            if i in long_at:
                top = run_tf[long_at[i]].astype(np.int64)
                bound = w * self.part_score(top, 8 * self.norm(run_length[long_at[i]]))
                starts = np.searchsorted(d, np.arange(self.runs + 1) * RUN).tolist()
                self.long[term] = (w, d, tf, starts, bound)
            else:
                self.short[term] = (d, w * self.part_score(tf, self.m[d]))

    @staticmethod
    def part_score(tf: np.ndarray, m8: np.ndarray) -> np.ndarray:
        """(10^9 * tf) div (1000 * tf + 8 * m); grows with tf, falls with the length."""
        return (1_000_000_000 * tf) // (1000 * tf + m8)

    def answer(self, terms: list[bytes], best: "Top") -> None:
        """Offer this block's documents for one item."""
        total = np.zeros(self.runs * RUN, np.int64)
        for t in terms:                                   # term at a time: the short lists
            if t in self.short:
                d, s = self.short[t]
                total[d] += s
        bound = total.reshape(self.runs, RUN).max(1)      # the accumulators as one bounded list
        lists = [self.long[t] for t in terms if t in self.long]
        lists.sort(key=lambda x: -x[0])
        for x in lists:
            bound = bound + x[4]
        for r in np.argsort(-bound, kind="stable").tolist():
            if bound[r] < best.least:
                break                                     # no later run can reach the k-th score
            score, left = total[r * RUN:(r + 1) * RUN].copy(), int(bound[r])
            left -= int(score.max())
            for w, d, tf, starts, above in lists:         # document at a time: this run only
                if score.max() + left < best.least:
                    break
                left -= int(above[r])
                a, b = starts[r], starts[r + 1]
                if a < b:
                    at = d[a:b]
                    score[at - r * RUN] += w * self.part_score(tf[a:b], self.m[at])
            else:
                for i in np.flatnonzero(score >= best.least).tolist():
                    best.offer(int(score[i]), self.ids[r * RUN + i])


class Top:
    """The ``k`` best (score, doc_id) of one item; equal scores by ascending id, null last."""

    def __init__(self, k: int):
        self.k, self.heap, self.least = k, [], 1      # a score of 0 doesn't count

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, -(1 << 64) if doc_id is None else -doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.k:
            self.least = max(self.heap[0][0], 1)

    def rows(self):
        return [(s, None if d == -(1 << 64) else -d) for s, d in self.heap]


def items_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per item: ``item`` (its number), ``item_id``, ``terms`` (distinct, sorted), ``size``."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [sorted(set(terms_of(x.as_py() or b""))) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))],
                names=["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"),
                        F.col(text).cast("binary").alias("text"))
    return materialise(rows.mapInArrow(run, f"item long, item_id {kind}, terms array<binary>"),
                       "search-items")


def search(spark: SparkSession, index: str, items: DataFrame, k: int = K,
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``k`` best documents of the index at ``index`` for each item of ``items_of``:
    ``item``, ``item_id``, ``rank``, ``doc_id``, ``score``."""
    small_batches(spark)
    sc = spark.sparkContext
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(index)
    sums = blocks.agg(F.sum("n_filled").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = int(sums["n"] or 0), int(sums["l"] or 0)
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item long, item_id {kind}, rank int, doc_id long, score long"
    out = shared_path(spark, "search-results")
    spark.createDataFrame([], schema).write.parquet(f"{out}/chunk-none")
    held = items.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t) + 8))
                     .alias("n")).first()["n"] or 0
    chunks = max(1, math.ceil(held / chunk_bytes)) if n_terms and held else 0
    for c in range(chunks):
        # about ``chunk_bytes`` of terms (one item is never cut): the chunk is broadcast, then freed
        asked = {r["item"]: [bytes(t) for t in r["terms"]] for r in items.where(
            F.pmod(F.xxhash64("item"), F.lit(chunks)) == c).select("item", "terms").toLocalIterator()}
        vocabulary = sc.broadcast(dict.fromkeys(itertools.chain.from_iterable(asked.values())))

        def frequencies(batches):
            for batch in batches:
                for words, counts in zip(batch.column(0), batch.column(1)):
                    found = wanted_terms(words.as_py(), vocabulary.value)
                    counts = np.frombuffer(counts.as_py(), "<u4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found.values()), pa.binary()),
                         pa.array([int(counts[i]) for i in found], pa.int64())], names=["term", "df"])

        # at most one row per term of the chunk
        df = (blocks.select("terms", "counts").mapInArrow(frequencies, "term binary, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect())
        weights = {bytes(r["term"]): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
                   for r in df}
        asked_of = sc.broadcast((asked, weights))

        def answer(batches):
            asked, weights = asked_of.value
            best = {i: Top(k) for i in asked}
            for batch in batches:
                for j in range(batch.num_rows):
                    block = Block({x: batch.column(x)[j].as_py() for x in NAMES}, weights, n_docs, n_terms)
                    for i, terms in asked.items():
                        block.answer(terms, best[i])
            rows = [(i, s, d) for i, top in best.items() for s, d in top.rows()]
            if rows:
                i, s, d = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.int64())],
                    names=["item", "doc_id", "score"])

        w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        (blocks.mapInArrow(answer, "item long, doc_id long, score long")
         .withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
         .join(items.select("item", "item_id"), "item")
         .select("item", "item_id", "rank", "doc_id", "score").write.parquet(f"{out}/chunk-{c:06d}"))
        vocabulary.destroy()
        asked_of.destroy()
    return spark.read.schema(schema).parquet(f"{out}/chunk-*")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = shared_path(spark, "lexical-index")
    build(table(spark, sf_dir, "documents"), index)
    return (search(spark, index, items_of(table(spark, sf_dir, "benchmark")))
            .select("item_id", "rank", "doc_id", "score"))


_TERMS_SQL = ("regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL.format(x='text')} AS t FROM documents),
len AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM len),
post AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf
         FROM (SELECT r, unnest(t) AS term FROM d) x GROUP BY r, term),
item AS (SELECT DISTINCT q, item_id, term FROM (
           SELECT q, item_id, unnest(t) AS term FROM (
             SELECT row_number() OVER () AS q, item_id, {_TERMS_SQL.format(x='text')} AS t
             FROM benchmark) y) z),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM post GROUP BY term) f, whole),
score AS (
  SELECT item.q, item.item_id, post.r, len.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_all) // l_all))))) AS BIGINT) AS score
  FROM item JOIN post USING (term) JOIN weight USING (term) JOIN len USING (r), whole
  GROUP BY item.q, item.item_id, post.r, len.doc_id)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS n
  FROM score WHERE score > 0) t
WHERE n <= 10"""
