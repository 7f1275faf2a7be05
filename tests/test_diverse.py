"""Group caps and maximal marginal relevance against plain Python."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from simcat.operators import diverse as DV
from simcat.operators import search as S
from tests.test_nn_descent import VEC, cloud, vectors

SPEC = replace(VEC, carry=("maker",))


@pytest.fixture(scope="module")
def table(spark):
    from simcat.session import materialise
    maker = F.when(F.col("vec_id") % 11 == 0, None).when(F.col("vec_id") < 90, "big").otherwise(
        F.concat(F.lit("m"), (F.col("vec_id") % 6).cast("string")))
    return materialise(vectors(spark, cloud(160)).withColumn("maker", maker))


def ranked(table, queries):
    out = {}
    for r in S.topk(queries, table, 1000, SPEC).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["maker"], r["score"]))
    return {q: [x[1:] for x in sorted(rows)] for q, rows in out.items()}


def plain_cap(rows, k, cap):
    seen, out = {}, []
    for i, maker, _ in rows:
        if maker is not None:
            seen[maker] = seen.get(maker, 0) + 1
            if seen[maker] > cap:
                continue
        out.append(i)
    return out[:k]


@pytest.mark.parametrize("k, cap, widen, block_rows", [(5, 1, 2, 2048), (12, 2, 0, 25), (12, 2, 1, 2048), (30, 3, 2, 2048)])
def test_cap_equals_the_plain_filter(table, k, cap, widen, block_rows):
    queries = table.where("vec_id % 8 = 0")
    got = {}
    for r in DV.capped(queries, table, k, cap, "maker", SPEC, block_rows, widen).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: [i for _, i in sorted(rows)] for q, rows in got.items()} == {
        q: plain_cap(rows, k, cap) for q, rows in ranked(table, queries).items()}
    assert all(sorted(n for n, _ in rows) == list(range(1, len(rows) + 1)) for rows in got.values())


def test_cap_edges(table):
    one = table.where("vec_id = 8")
    assert DV.capped(one, table, 0, 1, "maker", SPEC).count() == 0
    assert DV.capped(table.limit(0), table, 3, 1, "maker", SPEC).count() == 0
    assert {r["maker"] for r in DV.capped(one, table, 4, 0, "maker", SPEC).collect()} == {None}
    with pytest.raises(ValueError):
        DV.capped(one, table, 3, 1, "colour", SPEC)


def plain_mmr(rows, vec, k, balance, pool):
    rows, chosen = rows[:pool], []
    while len(chosen) < min(k, len(rows)):
        best = None
        for n, (i, _, s) in enumerate(rows):
            if i not in [c[0] for c in chosen]:
                near = max((round(float(vec[i] @ vec[c[0]]), 6) for c in chosen), default=0.0)
                value = round(balance * s - (1 - balance) * near, 6)
                if best is None or value > best[2]:
                    best = (i, n + 1, value)
        chosen.append(best)
    return chosen


@pytest.mark.parametrize("balance", [1.0, 0.5, 0.0])
def test_mmr_equals_the_plain_selection(table, balance):
    x = cloud(160)
    queries = table.where("vec_id % 20 = 0")
    got = {}
    for r in DV.mmr(queries, table, 6, balance, 15, SPEC).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["first_rank"], r["mmr"]))
    want = {q: plain_mmr(rows, x, 6, balance, 15) for q, rows in ranked(table, queries).items()}
    assert {q: [(i, n) for _, i, n, _ in sorted(r)] for q, r in got.items()} == {
        q: [(i, n) for i, n, _ in c] for q, c in want.items()}
    for q, rows in got.items():
        assert np.allclose([m for *_, m in sorted(rows)], [v for *_, v in want[q]], atol=2e-6)


def test_mmr_edges(table):
    assert DV.mmr(table.where("vec_id = 8"), table, 0, spec=SPEC).count() == 0
    assert DV.mmr(table.limit(0), table, 3, spec=SPEC).count() == 0
    with pytest.raises(ValueError):
        DV.mmr(table, table, 3, balance=1.5, spec=SPEC)
