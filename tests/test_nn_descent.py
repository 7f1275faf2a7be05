"""Neighbour descent against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from simcat.operators import nn_descent as D
from simcat.operators import search as S

VEC = S.RankSpec(id_col="vec_id", id_type="bigint", tiebreak=(), carry=("label",), keys_col="ekeys",
                 vals_col="evals")


def vectors(spark, x):
    rows = [(i, int(i % 3), [float(v) for v in r if v != 0]) for i, r in enumerate(x)]
    return (spark.createDataFrame(rows, "vec_id long, label int, evals array<double>").repartition(4)
            .withColumn("ekeys", F.transform("evals", lambda v, i: F.concat(F.lit("e:"), i.cast("string")))))


def pairs_of(df):
    return {(r["query_id"], r["vec_id"]) for r in df.collect()}


def cloud(n, dims=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)) + 2 * rng.standard_normal((20, dims))[rng.integers(0, 20, n)]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_small_tables_are_exact(spark):
    df = vectors(spark, cloud(60))
    got, found = D.knn(df, 5, VEC)
    want = S.topk_self(df, 5, VEC)
    key = ["query_id", "rank", "vec_id", "score", "label"]
    assert got.toPandas()[key].sort_values(key).values.tolist() == want.toPandas()[key].sort_values(key).values.tolist()
    assert found.stats[0][1] >= 60 * 59 // 2


def test_recall_and_compared_pairs(spark):
    n = 2000
    df = vectors(spark, cloud(n))
    got, found = D.knn(df, 5, VEC, run=32, orders=2)
    want = pairs_of(S.topk_self(df, 5, VEC))
    assert len(pairs_of(got) & want) / len(want) >= 0.95
    assert 0 < found.compared < 0.2 * n * (n - 1) / 2
    assert got.groupBy("query_id").count().where("count = 5").count() == n
    assert found.stats[-1][2] < found.stats[1][2]


def test_scores_are_exact_and_split_blocks_change_nothing(spark, monkeypatch):
    x = cloud(200)
    df = vectors(spark, x)
    want = pairs_of(D.knn(df, 4, VEC, run=16)[0])
    monkeypatch.setattr(D, "TASK_PAIRS", 500)
    monkeypatch.setattr(D, "BLOCK", 50)
    got = D.knn(df, 4, VEC, run=16)[0].collect()
    for r in got:
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), abs=1e-6)
    assert len(want & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) > 0.9


def test_a_third_of_equal_rows_and_rows_without_features(spark):
    x = cloud(240)
    x[::3] = x[0]
    x[1::40] = 0
    df = vectors(spark, x)
    got = D.knn(df, 3, VEC, run=32)[0]
    bare = [i for i in range(1, 240, 40)]
    assert {(r["query_id"], r["vec_id"]) for r in got.collect() if r["query_id"] in bare} == {
        (b, o) for b in bare for o in [i for i in (0, 1, 2, 3) if i != b][:3]}
    assert got.groupBy("query_id").count().where("count = 3").count() == 240
    same = got.where((F.col("query_id") % 3 == 0) & (F.col("score") > 0.99999))
    assert same.count() == 3 * (80 - 2)              # 80 copies but 2 that were emptied


def test_empty_and_single(spark):
    df = vectors(spark, cloud(5))
    assert D.knn(df.limit(0), 3, VEC)[0].count() == 0
    assert D.knn(df.where("vec_id = 1"), 3, VEC)[0].count() == 0
    assert pairs_of(D.knn(df.where("vec_id < 2"), 3, VEC)[0]) == {(0, 1), (1, 0)}


def test_rounds_ship_members_to_blocks_and_no_pairs(spark, monkeypatch):
    df = vectors(spark, cloud(600))
    seen, real = [], D._score
    monkeypatch.setattr(D, "_score", lambda lists, *a: seen.append((lists.columns, lists.count())) or real(lists, *a))
    _, found = D.knn(df, 5, VEC, run=16)
    assert len(seen) == len(found.stats) - 1
    assert all(columns == ["v", "m"] and n <= 600 for columns, n in seen)


def test_products_of_lists_among_themselves(spark):
    rng = np.random.default_rng(2)
    import pandas as pd
    pdf = pd.DataFrame({"ekeys": [rng.choice(40, 5, replace=False) for _ in range(9)],
                        "evals": [rng.random(5) for _ in range(9)]})
    dense = np.zeros((9, 40))
    for i, (k, v) in enumerate(zip(pdf["ekeys"], pdf["evals"])):
        dense[i, k] = v
    at = np.array([4, 0, 7])
    assert np.allclose(D.Lists(pdf, VEC).among(at), dense[at] @ dense[at].T)


def test_disk_does_not_grow_with_the_rounds(spark, monkeypatch):
    from pathlib import Path
    from simcat import session
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    df = session.materialise(vectors(spark, cloud(600)))
    tables = lambda: {p for p in root.iterdir() if any(p.iterdir())}
    before, most, real = tables(), [], D._keep
    monkeypatch.setattr(D, "_keep", lambda *a: most.append(len(tables() - before)) or real(*a))
    got, found = D.knn(df, 5, VEC, run=16)
    assert len(found.stats) > 3 and max(most) <= 3      # nodes, a graph and what a round scored
    assert len(tables() - before) == 2                  # nodes and the last graph
    assert got.count() == 600 * 5
