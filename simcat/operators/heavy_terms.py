"""The most frequent terms of a corpus by mergeable summaries and one exact recount.

Counting every n-gram exactly shuffles each distinct n-gram of every task.  Here each task keeps a
Misra-Gries summary of ``capacity`` terms: when there are more, the (capacity + 1)-th largest count is taken
off all of them and added to ``lost``.  A term's summed count is at most the sum of all ``lost`` too
small, and a term in no summary has at most that many places.  So if the k-th largest summed count is larger
than that sum, all of the top k are among the terms that come within it; these candidates are broadcast and
recounted exactly in a second pass.

Where the bound proves nothing, or leaves more than ``MAX_CANDIDATES``, the capacity is raised.  A pass that
loses nothing has counted exactly and needs no recount.  Corpora too flat for ``MAX_CAPACITY`` are counted by a
full aggregation.  The result is the same in all three cases.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from simcat.functions import text as TX
from simcat.operators.features import term_counts
from simcat.session import drop, map_columns, materialise

CAPACITY = 1 << 16
MAX_CAPACITY = 1 << 21
MAX_CANDIDATES = 1 << 17     # rows of a broadcast
CHUNK_ROWS = 1 << 20         # rows of term counts added up at once


@dataclass
class Heavy:
    """``terms``: term, df, cf, the most frequent first; how they were found."""
    terms: DataFrame
    capacity: int            # of the last summaries; 0 for a full aggregation
    lost: int                # the most that a summed count can lack
    shuffled: int            # rows that summaries and recount handed to their exchange
    candidates: int          # terms recounted; 0 if nothing was lost


def _counted(grams: pa.ListArray):
    """(term, count) of the batch; whole columns become lists, no dict per term."""
    found = pc.value_counts(grams.flatten())
    return zip(found.field("values").to_pylist(), found.field("counts").to_numpy().tolist())


def _summary(capacity: int):
    schema = pa.schema([("term", pa.string()), ("cf", pa.int64()), ("df", pa.int64())])

    def run(batches):
        cf: dict[str, int] = {}
        df: dict[str, int] = {}
        lost = 0
        for batch in batches:
            for term, n in _counted(batch.column(0)):
                cf[term] = cf.get(term, 0) + n
            for term, n in _counted(batch.column(1)):
                df[term] = df.get(term, 0) + n
            # twice the capacity, so that most batches need no cut
            if len(cf) > 2 * capacity:
                lost += _cut(cf, df, capacity)
        if len(cf) > capacity:
            lost += _cut(cf, df, capacity)
        terms = [None, *cf]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([lost, *cf.values()], pa.int64()),
             pa.array([0, *(df[t] for t in cf)], pa.int64())], schema=schema)

    return run


def _cut(cf: dict[str, int], df: dict[str, int], capacity: int) -> int:
    """Take the (capacity + 1)-th largest count off all; terms with nothing left go."""
    values = np.fromiter(cf.values(), dtype=np.int64, count=len(cf))
    off = int(np.partition(values, -capacity - 1)[-capacity - 1])
    for term in [t for t, n in cf.items() if n <= off]:
        del cf[term], df[term]
    for term in cf:
        cf[term] -= off
    return off


def _recount(terms):
    schema = pa.schema([("term", pa.string()), ("cf", pa.int64()), ("df", pa.int64())])

    def run(batches):
        wanted = pa.array(terms.value, pa.string())
        total = np.zeros((2, len(wanted)), dtype=np.int64)
        for batch in batches:
            for i in (0, 1):
                at = pc.index_in(batch.column(i).flatten(), value_set=wanted).drop_null()
                total[i] += np.bincount(at.to_numpy(), minlength=len(wanted))
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([wanted.take(pa.array(some)), *map(pa.array, total[:, some])], schema=schema)

    return run


def heavy_terms(docs: DataFrame, k: int, min_df: int = 1, text_col: str = "text", stop_words=None,
                capacity: int = CAPACITY, max_capacity: int = MAX_CAPACITY,
                max_candidates: int = MAX_CANDIDATES) -> Heavy:
    """The ``k`` terms (unigrams and bigrams) with the largest corpus count ``cf`` (ties by term) of those in
    at least ``min_df`` documents.

    Null and empty texts have no terms; rows with the same text all count; an empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    toks = docs.select(TX.tokens(text_col, list(stop_words) if stop_words else None).alias("_t"))
    grams = toks.select(F.coalesce(TX.with_bigrams("_t"), F.array().cast("array<string>")).alias("grams"))
    grams = grams.select("grams", F.array_distinct("grams").alias("once"))
    schema = "term string, cf long, df long"
    sums = [F.sum("cf").alias("cf"), F.sum("df").alias("df")]

    def first(counts: DataFrame) -> DataFrame:
        return (counts.where(F.col("df") >= min_df).orderBy(F.col("cf").desc(), F.col("term"))
                .limit(k).select("term", "df", "cf"))

    shuffled = 0
    while capacity <= max_capacity:
        parts = materialise(grams.mapInArrow(_summary(capacity), schema))
        shuffled += parts.where(F.col("term").isNotNull()).count()
        lost = parts.where(F.col("term").isNull()).agg(F.sum("cf")).first()[0] or 0
        found = materialise(parts.where(F.col("term").isNotNull()).groupBy("term").agg(*sums))
        if not lost:
            return Heavy(first(found), capacity, 0, shuffled, 0)
        # df is a lower bound too, so these k are terms that count
        bar = first(found).agg(F.count("*").alias("n"), F.min("cf").alias("cf")).first()
        if bar["n"] == k and bar["cf"] > lost:
            near = found.where(F.col("cf") >= bar["cf"] - lost).select("term")
            rows = near.limit(max_candidates + 1).collect()
            if len(rows) <= max_candidates:
                terms = spark.sparkContext.broadcast([r["term"] for r in rows])
                parts = materialise(grams.mapInArrow(_recount(terms), schema))
                shuffled += parts.count()
                return Heavy(first(parts.groupBy("term").agg(*sums)), capacity, lost, shuffled, len(rows))
        capacity *= 4
    ids = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))
    counts = term_counts(ids, "_row", "_text", stop_words)
    full = counts.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))
    return Heavy(first(full), 0, 0, shuffled, 0)


def _chunk_counts(keep):
    """cf and df of every term of each chunk of rows (term, tf), as far as ``keep`` takes them; and a row without
    a term for the chunk."""
    schema = pa.schema([("term", pa.string()), ("cf", pa.int64()), ("df", pa.int64())])

    def counted(held):
        found = pa.Table.from_batches(held).group_by("term").aggregate([("tf", "sum"), ("tf", "count")])
        found = keep(found.select(["term", "tf_sum", "tf_count"]).rename_columns(schema.names).cast(schema))
        return [*found.to_batches(), pa.RecordBatch.from_pydict({"term": [None], "cf": [1], "df": [0]}, schema=schema)]

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK_ROWS:
                yield from counted(held)
                held, n = [], 0
        if n:
            yield from counted(held)

    return run


def near_terms(tf: DataFrame, k: int, min_df: int = 1) -> DataFrame | None:
    """term, cf, df of the terms of ``tf`` (one row per document and term: term, tf) that can be among the ``k`` with
    the largest corpus count of those in at least ``min_df`` documents; None if most can.

    The largest counts of each chunk, added up, give a count that the k-th term has at least.  A term with that
    count has its share of it in some chunk: only terms with a share are exchanged, and what a term may have in
    the other chunks bounds its count.  The few that are left are counted in full.
    """
    schema = "term string, cf long, df long"
    sums = [F.sum("cf").alias("cf"), F.sum("df").alias("df"), F.count(F.lit(1)).alias("chunks")]

    def summed(keep):
        parts = materialise(map_columns(tf, ["term", "tf"], _chunk_counts(keep), schema))
        return parts, materialise(parts.where(F.col("term").isNotNull()).groupBy("term").agg(*sums))

    def least(found):
        # cf and df are lower bounds, so these k are terms that count
        bar = (found.where(F.col("df") >= min_df).orderBy(F.col("cf").desc()).limit(k)
               .agg(F.count("*").alias("n"), F.min("cf").alias("cf")).first())
        return bar["cf"] if bar["n"] == k else 0

    def largest(found):
        return pc.take(found, pc.select_k_unstable(found, k=2 * k, sort_keys=[("cf", "descending")]))

    parts, found = summed(largest)
    chunks = parts.where(F.col("term").isNull()).count()
    bar = least(found)
    drop(parts, found)
    share = -(-bar // max(chunks, 1))
    if share <= 1:
        return None
    parts, found = summed(lambda rows: rows.filter(pc.greater_equal(rows["cf"], share)))
    most = F.col("cf") + (F.lit(chunks) - F.col("chunks")) * F.lit(share - 1)
    near = [r["term"] for r in found.where(most >= max(bar, least(found))).select("term")
            .limit(MAX_CANDIDATES + 1).collect()]
    drop(parts, found)
    if len(near) > MAX_CANDIDATES:
        return None
    wanted = tf.sparkSession.sparkContext.broadcast(near)
    parts, found = summed(lambda rows: rows.filter(
        pc.is_in(rows["term"], value_set=pa.array(wanted.value, pa.string()))))
    drop(parts)
    return found.drop("chunks")
