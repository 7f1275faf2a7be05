import os
import tempfile

import pytest
from pyspark.sql import functions as F

from simcat.operators import normalise as N
from simcat.sources.ldjson import malformed_count, scan_ldjson

COLS = ["uniq_id", "product_name"]


def _write(lines):
    d = tempfile.mkdtemp(prefix="simcat-test-", dir="/tmp")
    p = os.path.join(d, "data.ldjson")
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


def test_malformed_lines_skipped_and_counted(spark):
    p = _write(['{"uniq_id": "a", "product_name": "first"}', "", "   ", "\t", " \t\u3000", "not json", "[1]",
                '{"uniq_id": "a", "product_name": "second"}', '{"uniq_id": "b"}'])
    raw = scan_ldjson(spark, p, COLS, keep_corrupt=True)
    c = malformed_count(raw).first()
    assert (c["good_lines"], c["skipped_lines"]) == (3, 2)
    good = scan_ldjson(spark, p, COLS)
    prods = N.normalise(good).select("product_id", "product_name").orderBy("product_id").collect()
    assert [(r[0], r[1]) for r in prods] == [("a", "first"), ("b", "")]


def test_missing_path_and_empty(spark):
    with pytest.raises(FileNotFoundError):
        scan_ldjson(spark, "/tmp/definitely/not/here.ldjson", COLS)
    p = _write(["not json", ""])
    with pytest.raises(ValueError):
        scan_ldjson(spark, p, COLS)


def test_missing_source_column_is_null(spark):
    df = spark.createDataFrame([("x1", "n", 0)], "uniq_id string, product_name string, src_seq long")
    with pytest.raises(ValueError):
        N.normalise(df.drop("src_seq"))
    out = N.normalise(df).first()
    assert out["brand"] is None and out["colour_tokens"] == [] and out["is_prime"] == 0.0


def test_keep_first_follows_file_order(spark):
    d = tempfile.mkdtemp(prefix="simcat-test-", dir="/tmp")
    with open(os.path.join(d, "a.ldjson"), "w") as fh:
        fh.write('{"uniq_id": "x", "product_name": "from a"}\n{"uniq_id": "y", "product_name": "y1"}\n'
                 '{"uniq_id": "y", "product_name": "y2"}\n')
    with open(os.path.join(d, "b.ldjson"), "w") as fh:
        fh.write('{"uniq_id": "x", "product_name": "from b"}\n')
    got = {r[0]: r[1] for r in N.normalise(scan_ldjson(spark, d, COLS))
           .select("product_id", "product_name").collect()}
    assert got == {"x": "from a", "y": "y1"}


def test_dedup_with_a_hot_id(spark):
    """One id holds a third of all rows, spread over many partitions: the earliest copy wins."""
    n = 30_000
    df = (spark.range(n, numPartitions=16)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                  .alias("product_id"),
                  F.concat(F.lit("name "), F.col("id").cast("string")).alias("product_name"),
                  (F.lit(n) - F.col("id")).alias("src_seq")))
    out = N.dedup_first(df)
    assert out.count() == 1 + (n - n // 3)
    hot = out.where(F.col("product_id") == "hot").first()
    # largest id divisible by 3 has the smallest src_seq
    assert hot["product_name"] == f"name {max(i for i in range(n) if i % 3 == 0)}"


def test_memo_follows_the_files(spark):
    from simcat.plans.memo import memo
    d = tempfile.mkdtemp(prefix="simcat-test-", dir="/tmp")
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("1")
    calls = []
    build = lambda: calls.append(1) or len(calls)
    assert memo(spark, ("t", d), build) == memo(spark, ("t", d), build) == 1
    with open(os.path.join(d, "a.txt"), "w") as fh:
        fh.write("changed")
    assert memo(spark, ("t", d), build) == 2


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from simcat.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
