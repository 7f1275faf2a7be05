"""Headline timings on one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Index builds are timed on their own; search queries then run on the built
(checkpointed) index, as a deployed service would.  Every query is executed in
full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from simcat.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    from simcat.plans.registry import load_all
    from simcat.plans import q_search as QS
    from simcat.plans.q_features import CFG_RAW, built, products

    qs = load_all()
    times: dict[str, float] = {}

    def run(name, fn, sf, record=True):
        t = time.time()
        out = fn(sf)
        if out is not None:
            out.write.format("noop").mode("overwrite").save()
        if record:
            times[name] = round(time.time() - t, 3)

    steps = [
        ("build_products", lambda sf: products(spark, sf).select("product_id")),
        ("build_index", lambda sf: built(spark, sf, CFG_RAW)[0].select("product_id")),
        ("build_index_svd", lambda sf: built(spark, sf, QS.CFG_DEFAULT)[0].select("product_id")),
        ("build_ann", lambda sf: QS._ann(spark, sf).cells.select("product_id")),
    ] + [(name, lambda sf, name=name: qs[name].build(spark, sf))
         for name in ("knn_all", "topk_exact", "topk_exact_svd", "topk_ann", "recall_at_k",
                      "knn_embeddings", "null_report", "parse_quality", "text_lengths_documents",
                      "ngrams")]
    # Warm-up outside the timings: the same steps once on the smallest tables, so
    # JVM code generation and Python workers are warm (results are not reused).
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name, fn in steps:
            run(name, fn, warm, record=False)
    for name, fn in steps:
        run(name, fn, sf_dir)
    n = products(spark, sf_dir).count()
    recall = qs["recall_at_k"].build(spark, sf_dir).first()["recall"]
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "products": n,
        "knn_all_ms_per_product": round(1000.0 * times["knn_all"] / max(n, 1), 3),
        "recall_at_10": recall,
    }))


if __name__ == "__main__":
    main()
