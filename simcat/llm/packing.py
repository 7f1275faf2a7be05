"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  A document of more tokens than the longest is cut into
pieces of that length and a rest.  Pieces are dealt into shards of bounded size by a hash, and each
shard is packed on its own, longest pieces first: a piece goes into the open bin with the least
room that holds it; without one a bin opens whose size has the least cost per token, given what
the pieces still to come would fill it with.  At the end each bin shrinks to the smallest permitted
size that holds its contents.

The cost of a sequence of c tokens is ``c + c * c / QUADRATIC + FIXED`` (linear layers, attention,
overhead of a sequence).

Lengths are token ids of the tokenizer that ``op10_token_ids`` uses and one end token (``id_counts``);
``pack_documents`` takes another count as a parameter.

Defined results: null and empty texts have just the end token and are packed like any other; ties
are broken by doc_id and piece, so a shard's bins don't depend on the order of its rows; repeated
ids are packed row by row; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import materialise, small_batches, table
from simcat.llm.repair import encoder_of, tokenizer_json

SIZES = (512, 1024, 2048, 4096, 8192)
QUADRATIC, FIXED = 16_384, 16
SHARD_PIECES = 50_000

PACKED = ("doc_id long, piece int, n_tokens int, shard int, bin int, start int, bin_tokens int, "
          "bin_size int")


def cost(size: int) -> float:
    return size + size * size / QUADRATIC + FIXED


def id_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``tokens``: ids that the tokenizer gives the text, and one end token."""
    spark = docs.sparkSession
    small_batches(spark)
    spec = spark.sparkContext.broadcast(tokenizer_json())     # one file of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64())])

    def run(batches):
        encoder = encoder_of(spec.value)
        for batch in batches:
            ids = encoder.encode([t.as_py() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) + 1 for i in ids], pa.int64())], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, tokens long"))


def pieces(counts: DataFrame, longest: int) -> DataFrame:
    """Documents cut to at most ``longest`` tokens: doc_id, piece, n_tokens."""
    last = F.greatest(F.ceil(F.col("tokens") / longest) - 1, F.lit(0)).cast("int")
    return (counts.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
            .select("doc_id", "piece",
                    F.least(F.col("tokens") - F.col("piece").cast("long") * longest,
                            F.lit(longest)).cast("int").alias("n_tokens")))


def pack(lengths: list[int], sizes: tuple[int, ...] = SIZES) -> list[tuple[int, int]]:
    """(bin, start) of each length; ``lengths`` must be descending and at most the largest size."""
    left: dict[int, int] = {}
    waiting = 0                                   # bit n: a length n is still to come
    for n in lengths:
        left[n] = left.get(n, 0) + 1
        waiting |= 1 << n
    rooms: dict[int, list[int]] = {}
    open_ = 0                                     # bit r: a bin with room r is open
    used: list[int] = []
    size_of: list[int] = []
    out = []

    def filled(room: int) -> int:
        """Tokens that the waiting lengths put into ``room``, longest first."""
        taken: dict[int, int] = {}
        total, mask = 0, waiting
        while room > 0:
            fit = mask & ((1 << (room + 1)) - 1)
            if not fit:
                break
            n = fit.bit_length() - 1
            k = min(room // n, left[n] - taken.get(n, 0))
            if k <= 0:
                mask &= ~(1 << n)
                continue
            taken[n] = taken.get(n, 0) + k
            if taken[n] == left[n]:
                mask &= ~(1 << n)
            total += k * n
            room -= k * n
        return total

    for n in lengths:
        left[n] -= 1
        if not left[n]:
            waiting &= ~(1 << n)
        able = open_ >> n
        if able:
            room = n + (able & -able).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_ &= ~(1 << room)
        else:
            size = min((c for c in sizes if c >= n), key=lambda c: (cost(c) / (n + filled(c - n)), c))
            b, room = len(used), size
            used.append(0)
            size_of.append(size)
        out.append((b, used[b]))
        used[b] += n
        room -= n
        if room:
            rooms.setdefault(room, []).append(b)
            open_ |= 1 << room
    return out


def downsize(n: int, sizes: tuple[int, ...] = SIZES) -> int:
    return min(c for c in sizes if c >= n)


def pack_documents(docs: DataFrame, sizes: tuple[int, ...] = SIZES, text: str = "text",
                   count=id_counts) -> DataFrame:
    """One row per piece: document, piece, tokens, shard, bin, start in the bin, the bin's tokens
    and its size after shrinking."""
    sizes = tuple(sorted(sizes))
    cut = materialise(pieces(count(docs, text), sizes[-1]), "pieces")
    shards = max(1, math.ceil(cut.count() / SHARD_PIECES))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True],
                              ignore_index=True)
        placed = pack(pdf["n_tokens"].tolist(), sizes)
        pdf["bin"] = np.array([b for b, _ in placed], dtype=np.int32)
        pdf["start"] = np.array([s for _, s in placed], dtype=np.int32)
        pdf["bin_tokens"] = pdf.groupby("bin")["n_tokens"].transform("sum").astype(np.int32)
        pdf["bin_size"] = pdf["bin_tokens"].map(lambda n: downsize(n, sizes)).astype(np.int32)
        return pdf[["doc_id", "piece", "n_tokens", "shard", "bin", "start", "bin_tokens", "bin_size"]]

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(run, PACKED)


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
