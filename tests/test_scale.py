"""What keeps searches and counts bounded on larger tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from simcat.operators import ann as A
from simcat.operators import buckets as B
from simcat.operators import search as S
from simcat.plans import q_text

SPEC = S.RankSpec(id_col="id", id_type="bigint", tiebreak=(("rating", "desc", -1.0),), carry=("label",))


def lists(spark, n, distinct, seed=5):
    """``n`` rows that share ``distinct`` feature lists, some of them empty."""
    rng = np.random.default_rng(seed)
    kinds = []
    for i in range(distinct):
        keys = sorted(rng.choice(12, int(rng.integers(0, 5)), replace=False).tolist())
        kinds.append(([f"k{x}" for x in keys], [float(v) for v in rng.integers(1, 4, len(keys)) / 3]))
    rows = [(i, i % 3, None if i % 7 == 0 else float(rng.integers(1, 4)), *kinds[int(rng.integers(0, distinct))])
            for i in range(n)]
    return rows, spark.createDataFrame(
        rows, "id long, label int, rating double, fkeys array<string>, fvals array<double>").repartition(4)


def brute(rows, k):
    out = {}
    for i, _, _, ka, va in rows:
        a = dict(zip(ka, va))
        near = [(-round(sum(a.get(x, 0.0) * y for x, y in zip(kb, vb)), 6), -(-1.0 if r is None else r), j)
                for j, _, r, kb, vb in rows if j != i]
        out[i] = [j for _, _, j in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("n,distinct", [(150, 9), (120, 120), (40, 1)])
def test_whole_table_scores_each_list_once(spark, monkeypatch, n, distinct):
    monkeypatch.setattr(S, "TILE", 16)
    rows, df = lists(spark, n, distinct)
    want = brute(rows, 4)
    asked = []
    real = S._lists_topk
    monkeypatch.setattr(S, "_lists_topk", lambda leads, *a: asked.append(leads.count()) or real(leads, *a))
    assert found(S.topk_self(df, 4, SPEC, block_rows=30)) == want
    assert asked[0] == len({(tuple(r[3]), tuple(r[4])) for r in rows})
    assert found(S.topk(df, df, 4, SPEC, block_rows=5)) == want


def test_rows_are_shipped_a_bounded_number_of_times(spark, monkeypatch):
    _, df = lists(spark, 400, 400)
    cores = spark.sparkContext.defaultParallelism
    real, cuts = S._block_of, []
    monkeypatch.setattr(S, "_block_of", lambda c, g: cuts.append(g) or real(c, g))
    S.topk_self(df, 3, SPEC, block_rows=1).collect()
    assert max(cuts) <= int(np.ceil(np.sqrt(6 * cores)))


def test_pairs_in_tiles_match_one_matrix(monkeypatch):
    rng = np.random.default_rng(1)

    def frame(ids):
        return pd.DataFrame({"id": ids, "fkeys": [np.sort(rng.choice(300, 6, replace=False)) for _ in ids],
                             "fvals": [rng.random(6) for _ in ids], "rating": rng.integers(0, 3, len(ids)).astype(float)})
    a, b = frame(np.arange(50)), frame(np.arange(50, 90))
    whole = S.pair_topk(a, b, 5, SPEC)
    monkeypatch.setattr(S, "TILE", 7)
    monkeypatch.setattr(S, "SPARSE", 0)        # without matrices
    key = ["query_id", "id"]
    parts = S.pair_topk(a, b, 5, SPEC)
    assert parts.sort_values(key).round(9).values.tolist() == whole.sort_values(key).round(9).values.tolist()


def test_large_cell_is_filed_in_sub_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "SUB_ROWS", 20)
    rows = [(i, 0, None, ["k1"], [1.0]) for i in range(400)] + [(400 + i, 0, None, [f"x{i}"], [1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label int, rating double, fkeys array<string>, fvals array<double>")
    index = A.build(df, SPEC, cells=20)
    assert index.cells.count() == 440
    sizes = index.cells.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.max() < 200


def test_sample_of_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(A, "FIT_ROWS", 50)
    df = spark.range(4000)
    low = A._low_hashes(df, "id", 4000)
    order = [F.xxhash64("id"), F.col("id")]
    assert low.count() < 200
    assert low.orderBy(*order).limit(50).collect() == df.orderBy(*order).limit(50).collect()


def test_all_buckets_need_no_map(spark, monkeypatch):
    rows, df = lists(spark, 90, 60)
    index = B.build(df, SPEC, tables=2, bits=4)
    monkeypatch.setattr(B, "probe_map", None)      # a map would have an entry per query and bucket
    want = brute(rows, 5)
    got = found(B.search(df.where("id % 9 = 0"), index, 5, probes=16))
    assert got == {i: want[i] for i in range(0, 90, 9)}


def test_documents_are_counted_in_tasks_of_bounded_text(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(q_text, "TASK_BYTES", 100)
    docs = spark.createDataFrame([(i, "alpha beta gamma delta " * 4) for i in range(300)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tf, n = q_text.doc_term_counts(spark, str(tmp_path))
    assert n == 300 and tf.rdd.getNumPartitions() >= 200
    assert tf.where("term = 'alpha'").agg(F.sum("tf")).first()[0] == 1200


def test_one_id_for_different_lists_is_an_error(spark):
    _, df = lists(spark, 30, 30)
    with pytest.raises(ValueError, match="several rows"):
        S.topk_self(df.withColumn("id", F.col("id") % 10), 3, SPEC)


def test_svd_pieces_with_few_columns_are_multiplied_as_matrices(monkeypatch):
    from simcat.operators import svd as V
    rng = np.random.default_rng(8)
    asked, real = [], V._matrix
    monkeypatch.setattr(V, "_matrix", lambda *a: asked.append(real(*a)) or asked[-1])
    for terms, dense in ((30, True), (5000, False)):
        a = np.zeros((300, terms))
        for row in a[1:]:                      # the first row has no weight
            row[rng.choice(terms, 5, replace=False)] = rng.random(5)
        r, c = np.nonzero(a)
        z, y = rng.random((terms, 7)), rng.random((300, 7))
        assert np.allclose(V._times(300, r, c, a[r, c], z), a @ z)
        out = np.ones((terms, 7))
        V._add_transposed(out, r, c, a[r, c], y)
        assert np.allclose(out, 1 + a.T @ y)
        assert all((m is not None) == dense for m in asked) and len(asked) == 2
        asked.clear()


def written(path):
    return {p: p.stat().st_size for p in path.rglob("part-*")}


def test_term_counts_are_kept_compressed(spark, tmp_path):
    from pathlib import Path
    from simcat.session import drop, materialise, packed
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    rows = [(i // 50 if i % 7 else None, f"word{i % 90} word{i % 31}", i % 4) for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, term string, tf long").repartition(5).cache()
    before = written(root)
    plain = materialise(df)
    size = sum(written(root).values()) - sum(before.values())
    drop(plain)
    assert written(root) == before                # nothing is left of a dropped table
    small = packed(df)
    assert sum(written(root).values()) - sum(before.values()) < size / 3
    assert small.rdd.getNumPartitions() == df.rdd.getNumPartitions() and small.schema == df.schema
    assert sorted(small.collect(), key=str) == sorted(df.collect(), key=str)
    assert packed(df.limit(0)).count() == 0


@pytest.mark.parametrize("flat", [False, True])
def test_only_terms_that_can_be_frequent_are_exchanged(spark, monkeypatch, flat):
    from simcat.operators import features as FT
    from simcat.operators import heavy_terms as H
    from simcat.session import packed
    monkeypatch.setattr(H, "CHUNK_ROWS", 700)
    rng = np.random.default_rng(3)
    rows = {}
    for doc in range(400):
        for t in rng.integers(0, 3000, 30) if flat else rng.zipf(1.3, 60) % 3000:
            rows[doc, f"t{t:04d}"] = rows.get((doc, f"t{t:04d}"), 0) + 1
    rows |= {(0, f"once{i}"): 500 + i for i in range(9)}         # often, but in one document
    tf = spark.createDataFrame([(d, t, n) for (d, t), n in rows.items()], "doc_id long, term string, tf long").repartition(6)
    near = H.near_terms(tf, 40, 3)
    want = FT.top_terms(tf, 3, 40)
    assert len(want) == 40 and FT.top_terms(tf, 3, 40, many=True) == want
    assert FT.top_terms(tf, 3, 10 ** 6, many=True) == FT.top_terms(tf, 3, 10 ** 6)
    if flat:
        assert near is None
    else:
        assert near.count() < 300
        full = {r["term"]: (r["df"], r["cf"]) for r in tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).collect()}
        assert {r["term"]: (r["df"], r["cf"]) for r in near.collect()}.items() <= full.items()
    small = packed(tf)
    assert FT.top_terms(small, 3, 40, many=True) == want
    model = FT.FeatureModel(weights={}, vocab=FT.with_idf(want, 400))
    rows = lambda t: sorted((r["doc_id"], r["term"], round(r["w"], 9)) for r in FT.tfidf(t, model, "doc_id").collect())
    assert rows(small) == rows(tf)


def test_svd_passes_run_in_few_tasks(spark, monkeypatch):
    from simcat.operators import svd as V
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 6 * cores, 1, 6 * cores).selectExpr("array(int(id), int(id) + 1) AS idx")
    assert V._in_few_tasks(rows).rdd.getNumPartitions() == cores
    monkeypatch.setattr(V, "PASS_VALUES", 3)         # 12 non-zeros for each core
    assert V._in_few_tasks(rows).rdd.getNumPartitions() == 4 * cores
