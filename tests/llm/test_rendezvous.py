"""Rendezvous sharding: the law, gapless slots, weights, hot keys and the files' round trip."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simcat.llm import rendezvous as R
from simcat.llm.common import shared_path


def plain_shard(key, weights):
    best = None
    for i, w in enumerate(weights):
        if w > 0:
            h = int(hashlib.md5(f"{'' if key is None else key}:{i}".encode()).hexdigest()[:13], 16)
            s = -w / math.log((h + 0.5) / (1 << 52))
            best = max(best or (s, -i), (s, -i))
    return -best[1]


def run(spark, rows, weights, parts=None, **kw):
    path = shared_path(spark, "test-shards")
    docs = spark.createDataFrame([(i, t, "c", 9) for i, t in rows],
                                 "doc_id long, text string, shard string, `at.x` int").repartition(3)
    R.write(docs, path, weights, parts=parts, **kw)
    return R.read(spark, path), docs


ROWS = [(i, f"text {i}") for i in range(400)] + [(400, None), (401, ""), (402, "é" * 200_000), (403, "same"),
                                                 (403, "same"), (403, "other"), (None, "null id"), (None, None)]


@pytest.mark.parametrize("parts", [1, 5])
def test_law_slots_and_round_trip(spark, parts):
    weights = [1.0] * 8
    out, docs = run(spark, ROWS, weights, parts)
    got = out.select("record.*", F.col("shard").alias("s"), "slot", "grown_shard").collect()
    assert sorted(((r["doc_id"], r["text"], r["shard"], r["at.x"]) for r in got), key=repr) == \
        sorted(((i, t, "c", 9) for i, t in ROWS), key=repr)
    for r in got:
        assert r["s"] == plain_shard(r["doc_id"], weights)
        assert r["grown_shard"] == plain_shard(r["doc_id"], weights + [1.0])
        assert r["grown_shard"] in (r["s"], 8)
    for s, n in Counter(r["s"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["s"] == s) == list(range(n))
    moved = sum(r["grown_shard"] == 8 for r in got) / len(got)
    assert 0.05 < moved < 0.2


def test_slots_do_not_depend_on_the_number_of_parts(spark):
    one, many = (sorted((r["record"]["doc_id"], r["record"]["text"], r["shard"], r["slot"])
                        for r in run(spark, ROWS[:403], [1.0] * 4, p)[0].collect()) for p in (1, 7))
    assert one == many


def test_weights(spark):
    rows = [(i, "") for i in range(4000)]
    got = Counter(r["shard"] for r in run(spark, rows, [1.0, 3.0, 0.0])[0].select("shard").collect())
    assert set(got) == {0, 1} and 0.70 < got[1] / 4000 < 0.80
    for bad in ([], [0.0], [-1.0, 2.0], [float("nan"), 1.0]):
        with pytest.raises(ValueError):
            R.place(F.lit(1), bad)


def test_a_key_shared_by_many_rows_spans_parts(spark):
    rows = [(None, "copy")] * 600 + [(i, "x") for i in range(300)]
    out, _ = run(spark, rows, [1.0] * 3, 6)
    own = plain_shard(None, [1.0] * 3)
    hot = [r["slot"] for r in out.where("record.doc_id IS NULL").collect()]
    assert len(set(hot)) == 600 and out.where(F.col("shard") == own).agg(F.max("slot")).first()[0] + 1 == \
        out.where(F.col("shard") == own).count()
    path = shared_path(spark, "test-shards")
    R.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, [1.0] * 3, parts=6)
    manifest = spark.read.parquet(f"{path}/manifest")
    assert manifest.count() <= 6 + 3 and manifest.agg(F.max("rows")).first()[0] < 400


def test_empty_table_and_digest(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(str(tmp_path / "e/documents.parquet"))
    assert R.op12_sharding(spark, str(tmp_path / "e")).count() == 0
    spark.createDataFrame([(1, "é"), (2, None)], "doc_id long, text string").write.parquet(
        str(tmp_path / "d/documents.parquet"))
    got = {r["doc_id"]: r for r in R.op12_sharding(spark, str(tmp_path / "d")).collect()}
    assert (got[1]["size"], got[1]["text_crc32"]) == (3, zlib.crc32("é".encode()))
    assert (got[2]["size"], got[2]["text_crc32"], got[2]["law"]) == (1, 0, "key")
