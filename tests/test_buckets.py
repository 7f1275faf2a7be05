"""Sign buckets against exact search; recall of the inverted file from cell ranks."""

import numpy as np
import pytest

from simcat.operators import ann as A
from simcat.operators import buckets as B
from simcat.operators import search as S
from simcat.operators import signs as G
from tests.test_nn_descent import VEC, cloud, pairs_of, vectors

KEY = ["query_id", "rank", "vec_id", "score"]


def rows_of(df):
    return df.toPandas()[KEY].sort_values(KEY).values.tolist()


@pytest.fixture(scope="module")
def table(spark):
    from simcat.session import materialise
    return materialise(vectors(spark, cloud(800)))


def test_all_buckets_give_the_exact_result_and_few_give_most(table):
    queries = table.where("vec_id % 7 = 0")
    want = S.topk(queries, table, 6, VEC)
    index = B.build(table, VEC, tables=6, bits=5)
    assert rows_of(B.search(queries, index, 6, probes=32)) == rows_of(want)
    assert rows_of(B.search(queries, index, 6, probes=32, block_rows=40)) == rows_of(want)
    few = pairs_of(B.search(queries, index, 6, probes=6))
    assert len(few & pairs_of(want)) / len(pairs_of(want)) > 0.9


def test_probed_codes_come_in_order_of_cost():
    p = np.array([[0.9, -0.1, 0.5], [-0.2, 0.3, -0.8]])
    codes = B.probed_codes(p, 4)
    assert codes[0].tolist() == [0b101, 0b111, 0b100, 0b110]
    assert codes[1].tolist() == [0b010, 0b110, 0b000, 0b100]
    everything = B.probed_codes(np.random.default_rng(1).standard_normal((5, 10)), 1024)
    assert all(sorted(r) == list(range(1024)) for r in everything.tolist())


def test_directions_are_balanced_and_repeatable():
    keys = np.arange(4000, dtype=np.int64) * 977
    d = G.directions(keys, 100, 7)
    assert d.shape == (4000, 100) and set(np.unique(d)) == {-1.0, 1.0}
    assert np.abs(d.mean(0)).max() < 0.08 and (d == G.directions(keys, 100, 7)).all()
    assert np.abs(d.T @ d / 4000 - np.eye(100)).max() < 0.1


def test_a_hot_bucket_rows_without_features_and_empty_tables(spark):
    x = cloud(150)
    x[::3] = x[0]
    x[10] = 0
    df = vectors(spark, x)
    index = B.build(df, VEC)
    got = B.search(df, index, 4, probes=1 << index.bits)
    assert rows_of(got) == rows_of(S.topk(df, df, 4, VEC))
    assert B.search(df.limit(0), index, 4).count() == 0 and B.search(df, index, 0).count() == 0
    assert B.search(df, B.build(df.limit(0), VEC), 4).count() == 0
    with pytest.raises(ValueError):
        B.build(df, VEC, bits=40)


def test_recall_curve_is_what_a_search_of_that_many_cells_gives(table):
    queries = table.where("vec_id % 9 = 0")
    exact = S.topk(queries, table, 5, VEC)
    index = A.build(table, VEC, cells=12)
    n = queries.count()
    curve = {r["nprobe"]: r["recall"] for r in A.recall_curve(
        A.cell_ranks(exact, queries, index), n, 5, len(index.centers)).collect()}
    assert sorted(curve) == [1, 2, 4, 8, 12] and curve[12] == 1.0
    for p in (1, 4):
        assert curve[p] == A.recall_at_k(exact, A.search(queries, index, 5, p), n, 5, "vec_id").first()["recall"]
