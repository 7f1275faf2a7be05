"""Sharding by weighted rendezvous hashing of a stable record key.

Every shard draws a score for a key, ``-weight / ln(u)`` with ``u`` in (0, 1) made from the MD5 of
"key:shard", and the largest score wins.  A score depends on the key and its own shard alone, so a
shard that is added (or whose weight grows) takes rows only into itself, a shard that goes gives its
rows to the others, and a shard's share of the keys is its share of the weights.

``write`` puts the records into one folder per shard: rows are exchanged by a range of (shard, key,
size, checksum, place in the input), so a shard is spread over many tasks, and so is a key that many
rows share.  A manifest with one row per written part holds the number of rows before it in its
shard; a record's slot is that number plus its place in the part.  ``read`` gives the records back
with shard and slot.

Defined results: a null key is an ordinary key (an empty text); null text has size 1 and the
checksum of no bytes; equal keys share a shard and get different slots in the order of (key, size,
checksum, place in the input); an empty table gives empty files; the caller's columns travel as one
struct, so their names can't clash; a shard of weight 0 gets nothing, other weights must be above 0.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from simcat.llm.common import shared_path, table

SHARDS = 8
LAW = "key"
IN_PART = (1 << 33) - 1      # low bits of monotonically_increasing_id: a row's place in its partition


def score(key: Column, shard: int, weight: float) -> Column:
    """What ``shard`` offers for ``key``; 52 bits of the digest, so ``u`` is never 0 or 1."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return F.lit(-float(weight)) / F.log((bits + 0.5) / F.lit(float(1 << 52)))


def best_shard(scores: list[tuple[int, Column]]) -> Column:
    """The shard with the largest score; the lowest number of equal ones."""
    top = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("shard"))
                                for i, s in scores]))
    return (-top["shard"]).cast("int")


def place(key: Column, weights: list[float], grown_weight: float = 1.0) -> tuple[Column, Column]:
    """(shard under ``weights``, shard when one more of ``grown_weight`` is added) of ``key``."""
    if not any(w > 0 for w in weights) or any(w < 0 or not math.isfinite(w) for w in weights):
        raise ValueError("weights must be finite, not negative, and not all 0")
    if not grown_weight > 0 or not math.isfinite(grown_weight):
        raise ValueError("the added shard needs a finite weight above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    own = [(i, score(text, i, w)) for i, w in enumerate(weights) if w > 0]
    return best_shard(own), best_shard(own + [(len(weights), score(text, len(weights), grown_weight))])


def sizes(text: Column) -> tuple[Column, Column]:
    """UTF-8 bytes plus 1, and the unsigned crc32 of the bytes."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    return (F.octet_length(data) + 1).cast("long"), F.crc32(data)


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def write(docs: DataFrame, path: str, weights: list[float], grown_weight: float = 1.0,
          key: str = "doc_id", text: str = "text", parts: int | None = None) -> None:
    """Write the records under ``path``: ``rows/shard=i/``, ``manifest/`` and ``layout/``."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard, grown = place(column(key), weights, grown_weight)
    size, crc = sizes(column(text))
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("record"),
                       column(key).alias("key"), shard.alias("shard"), grown.alias("grown_shard"),
                       size.alias("size"), crc.alias("crc"),
                       F.monotonically_increasing_id().alias("at"))
    order = ["shard", "key", "size", "crc", "at"]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    (placed.select("shard", "grown_shard", F.spark_partition_id().alias("part"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PART)).alias("at"), "record")
     .write.partitionBy("shard").parquet(f"{path}/rows"))

    record = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("record")).schema
    layout = json.dumps({"record": record.jsonValue(), "weights": list(map(float, weights)),
                         "grown_weight": float(grown_weight)})
    spark.createDataFrame([(layout,)], "layout string").coalesce(1).write.parquet(f"{path}/layout")
    # one row per written part and shard: at most parts + shards of them
    runs = (_rows(spark, path, record).groupBy("shard", "part")
            .agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("rows")))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (runs.withColumn("first_slot", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long"))
     .write.parquet(f"{path}/manifest"))


MANIFEST = "shard int, part int, first_at long, rows long, first_slot long"


def _rows(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    fields = [T.StructField("grown_shard", T.IntegerType()), T.StructField("part", T.IntegerType()),
              T.StructField("at", T.LongType()), *record.fields, T.StructField("shard", T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{path}/rows")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written records: ``record`` (struct of the caller's columns), ``shard``, ``slot``,
    ``grown_shard``."""
    layout = json.loads(spark.read.parquet(f"{path}/layout").first()["layout"])
    record = T.StructType.fromJson(layout["record"])
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # at most (parts of one stage + shards) rows of 28 bytes
    return (_rows(spark, path, record).join(F.broadcast(manifest.drop("rows")), ["shard", "part"])
            .select("record", "shard", (F.col("at") - F.col("first_at") + F.col("first_slot"))
                    .alias("slot"), "grown_shard"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "shards")
    write(table(spark, sf_dir, "documents"), path, [1.0] * SHARDS)
    size, crc = sizes(F.col("record.text"))
    return read(spark, path).select(F.col("record.doc_id").alias("doc_id"), size.alias("size"),
                                    crc.alias("text_crc32"), F.lit(LAW).alias("law"), "shard",
                                    "slot", "grown_shard")


def _shard_sql(shards: int) -> str:
    """The shard whose hash is largest: with equal weights the order of -1 / ln(u) is that of u."""
    return ("list_position(h, list_max(h)) - 1 AS shard FROM (SELECT *, [" + ", ".join(
        f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{i}'), 1, 13) AS BIGINT)"
        for i in range(shards)) + "] AS h")


# One entry of the table of the reflected CRC-32 polynomial 0xEDB88320, made by its rule.
_CRC_ENTRY = ("list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) "
              "ELSE c >> 1 END, CAST(i AS BIGINT))")

ORACLE = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: {_CRC_ENTRY}) AS t),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT doc_id, CAST(octet_length(b) + 1 AS BIGINT) AS size,
        list_transform(regexp_extract_all(hex(b), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS bytes FROM d),
y AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]),
        4294967295), 4294967295) AS text_crc32 FROM x, crc),
s AS (SELECT doc_id, size, text_crc32, {_shard_sql(SHARDS)} FROM y) a),
g AS (SELECT doc_id, size, text_crc32, shard, grown_shard FROM (
        SELECT s.*, k.grown_shard FROM s JOIN (
          SELECT doc_id, shard AS grown_shard FROM (SELECT doc_id, {_shard_sql(SHARDS + 1)} FROM documents) b)
        ) k USING (doc_id)) c)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM g"""
