"""The most frequent terms by summaries and a recount: the rows of a full count."""

import random
from collections import Counter

import pytest

from simcat.operators import heavy_terms as H


def texts(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}x" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    return [" ".join(rng.choices(words, weight, k=rng.randrange(0, 40))) for _ in range(n)]


def expected(rows, k, min_df):
    cf, df = Counter(), Counter()
    for t in rows:
        w = (t or "").split()
        grams = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        cf.update(grams)
        df.update(set(grams))
    best = sorted((t for t in cf if df[t] >= min_df), key=lambda t: (-cf[t], t))[:k]
    return [(t, df[t], cf[t]) for t in best]


@pytest.mark.parametrize("capacity, how", [(1 << 16, "exact"), (1000, "recount"), (16, "raised"), (1 << 22, "full")])
def test_same_rows_as_a_full_count(spark, capacity, how):
    rows = texts(1) + [None, "", "solo"]
    docs = spark.createDataFrame([(t, 1) for t in rows], "text string, cf int").repartition(3)
    got = H.heavy_terms(docs, 20, 3, capacity=capacity)
    assert [tuple(r) for r in got.terms.collect()] == expected(rows, 20, 3)
    assert (got.lost > 0) == (how == "recount" or how == "raised" and got.candidates > 0)
    if how == "recount":
        assert got.capacity == 1000 and 20 <= got.candidates < 1000
    if how == "raised":
        assert got.capacity > 16
    if how == "full":
        assert got.capacity == 0


def test_ties_too_many_candidates_and_no_rows(spark):
    rows = [f"t{i:03d}x" for i in range(300)] * 2
    docs = spark.createDataFrame([(t,) for t in rows], "text string").repartition(2)
    got = H.heavy_terms(docs, 5, 2, capacity=50, max_candidates=10)
    assert [tuple(r) for r in got.terms.collect()] == expected(rows, 5, 2)
    assert H.heavy_terms(docs.limit(0), 5).terms.collect() == []
    # fewer terms than asked for
    assert H.heavy_terms(docs, 1000, 2, capacity=50).terms.count() == 300


def test_a_summary_lacks_at_most_what_it_lost():
    import pyarrow as pa
    rng = random.Random(3)
    grams = [[f"g{min(int(rng.expovariate(0.02)), 500)}" for _ in range(50)] for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(part), pa.array([sorted(set(g)) for g in part])],
                                          names=["grams", "once"])
               for part in (grams[a:a + 20] for a in range(0, 200, 20))]
    out = next(H._summary(40)(batches)).to_pylist()
    lost, counts = out[0]["cf"], {r["term"]: r["cf"] for r in out[1:]}
    true = Counter(g for row in grams for g in row)
    assert out[0]["term"] is None and len(counts) <= 40 and lost > 0
    assert all(true[t] - lost <= counts.get(t, 0) <= true[t] for t in true)
    assert lost <= sum(true.values()) / 40
