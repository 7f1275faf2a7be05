import json
import os
import tempfile

from simcat.streaming import ingest_stream


def test_ingest_dedups_across_files(spark):
    root = tempfile.mkdtemp(prefix="simcat-stream-", dir="/tmp")
    src, sink, ck = (os.path.join(root, x) for x in ("src", "sink", "ck"))
    os.makedirs(src)
    rows1 = [{"uniq_id": "a", "product_name": "first", "sales_price": "1,299.00"}, "not json",
             {"uniq_id": "b", "product_name": "bee", "colour": "Red|blue"}]
    with open(os.path.join(src, "part1.ldjson"), "w") as fh:
        for r in rows1:
            fh.write((json.dumps(r) if isinstance(r, dict) else r) + "\n")
    q = ingest_stream(spark, src, sink, ck, available_now=True)
    q.awaitTermination(120)
    with open(os.path.join(src, "part2.ldjson"), "w") as fh:
        fh.write(json.dumps({"uniq_id": "a", "product_name": "again"}) + "\n")
        fh.write(json.dumps({"uniq_id": "c", "product_name": "sea"}) + "\n")
    q = ingest_stream(spark, src, sink, ck, available_now=True)
    q.awaitTermination(120)
    out = {r["product_id"]: r for r in spark.read.parquet(sink).collect()}
    assert sorted(out) == ["a", "b", "c"]
    assert out["a"]["product_name"] == "first" and out["a"]["sales_price"] == 1299.0
    assert out["b"]["colour_tokens"] == ["red", "blue"]
