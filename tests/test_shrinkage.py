"""Shrunk ratings against the formulas in plain Python."""

import numpy as np
import pytest

from simcat.operators import shrinkage as SH


def frame(spark, rows):
    return (spark.createDataFrame([(p, c, r) for p, c, r, _ in rows],
                                  "product_id string, child_category string, rating double"),
            spark.createDataFrame([(p, n) for p, _, _, n in rows if n != -1], "product_id string, reviews double"))


def plain(rows, unknown=1.0):
    rated = [(c, r) for _, c, r, _ in rows if r is not None]
    centre = np.mean([r for _, r in rated])
    groups = {}
    for c, r in rated:
        if c is not None:
            groups.setdefault(c, []).append(r)
    n = {c: len(v) for c, v in groups.items()}
    total, k = sum(n.values()), len(n)
    within = sum(np.var(v) * len(v) for v in groups.values()) / (total - k)
    own = sum(map(sum, groups.values())) / total
    spread = sum(n[c] * (np.mean(v) - own) ** 2 for c, v in groups.items())
    between = max(0.0, (spread - (k - 1) * within) / (total - sum(x * x for x in n.values()) / total))
    w = lambda m: m * between / (m * between + within)
    out = {}
    for p, c, r, m in rows:
        prior = w(n[c]) * np.mean(groups[c]) + (1 - w(n[c])) * centre if c in n else centre
        m = unknown if m in (None, -1) else m
        out[p] = None if r is None else w(m) * r + (1 - w(m)) * prior
    return out


def test_equals_the_formulas(spark):
    rng = np.random.default_rng(4)
    rows = [(f"p{i}", f"c{i % 5}", float(np.clip(3 + 0.5 * (i % 5) + rng.normal(0, 0.6), 0, 5)), float(rng.integers(0, 200)))
            for i in range(200)]
    rows += [("none", None, 4.0, 10.0), ("bare", "c1", None, 3.0), ("new", "c2", 5.0, None), ("gone", "c3", 5.0, -1),
             ("alone", "c9", 1.0, 0.0)]
    out, prior = SH.shrink(*frame(spark, rows))
    got = {r["product_id"]: r["rating_shrunk"] for r in out.collect()}
    want = plain(rows)
    assert got["bare"] is None and want.pop("bare") is None
    assert all(got[p] == pytest.approx(v, abs=1e-6) for p, v in want.items())
    assert 0 < prior.strength < float("inf")
    few, many = SH.shrink(*frame(spark, rows + [("few", "c0", 5.0, 1.0), ("many", "c0", 5.0, 500.0)]))[0].where(
        "product_id IN ('few', 'many')").orderBy("product_id").collect()
    assert few["rating_shrunk"] < many["rating_shrunk"] <= 5.0


def test_no_variance_between_or_within(spark):
    same = [(f"p{i}", f"c{i % 2}", 3.0 + (i // 2) % 2, 9.0) for i in range(8)]
    out, prior = SH.shrink(*frame(spark, same))
    assert prior.between == 0 and prior.strength == float("inf")
    assert {r["rating_shrunk"] for r in out.collect()} == {3.5}
    flat = [(f"p{i}", f"c{i % 2}", 4.0, 2.0) for i in range(6)]
    assert {r["rating_shrunk"] for r in SH.shrink(*frame(spark, flat))[0].collect()} == {4.0}
    apart = [(f"p{i}", f"c{i % 2}", 2.0 + i % 2, 2.0) for i in range(6)]
    assert {r["rating_shrunk"] for r in SH.shrink(*frame(spark, apart))[0].collect()} == {2.0, 3.0}


def test_empty_and_unrated(spark):
    assert SH.shrink(*frame(spark, []))[0].count() == 0
    out, _ = SH.shrink(*frame(spark, [("a", "c", None, 3.0), ("b", None, None, None)]))
    assert {r["rating_shrunk"] for r in out.collect()} == {None}
