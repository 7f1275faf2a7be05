import numpy as np
from pyspark.sql import functions as F

from simcat.config import Config
from simcat.operators.quantiles import quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.lognormal(3, 2, 5000), np.full(3000, 7.0)])
    few = vals[:11]
    df = spark.createDataFrame(
        [("a", float(v)) for v in vals] + [("b", float(v)) for v in few]
        + [(None, float(v)) for v in vals[:500]] + [("one", 4.0), ("b", None), ("b", float("nan"))],
        "k string, v double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {(r["k"], r["p"]): r["q"] for r in quantiles(df, "k", "v", probs).collect()}
    assert len(got) == 4 * len(probs)
    for p in probs:
        assert np.isclose(got[("a", p)], np.quantile(vals, p))
        assert np.isclose(got[("b", p)], np.quantile(few, p))
        assert np.isclose(got[(None, p)], np.quantile(vals[:500], p))
        assert got[("one", p)] == 4.0
    assert quantiles(df.limit(0), "k", "v", probs).count() == 0


def test_quantiles_send_no_value_to_the_driver():
    """No collecting call in the module: its result is a plan."""
    import inspect
    from simcat.operators import quantiles as module
    source = inspect.getsource(module)
    assert not any(call in source for call in (".collect(", "toPandas", "toLocalIterator", ".first()", ".take("))


def test_svd_inner_products(spark):
    """Fast-decaying spectrum: projected inner products match an exact SVD."""
    from simcat.operators.features import FeatureModel
    from simcat.operators.svd import fit_svd
    rng = np.random.default_rng(0)
    n, t, k = 300, 40, 5
    a = (rng.standard_normal((n, k)) * np.array([10, 6, 4, 2, 1])) @ rng.standard_normal((k, t))
    a += 0.01 * rng.standard_normal((n, t))
    rows = [(i, j, j, float(a[i, j])) for i in range(n) for j in range(t)]
    w = spark.createDataFrame(rows, "product_id int, term int, term_idx int, w double")
    model = FeatureModel(weights={}, vocab=[(str(j), 1, 1.0) for j in range(t)], n_docs=n)
    svd = fit_svd(w, model, k, Config(svd_power_iters=3))
    _, _, vt = np.linalg.svd(a, full_matrices=False)
    exact = a @ vt[:k].T
    approx = a @ svd.components.T
    assert np.abs(exact @ exact.T - approx @ approx.T).max() < 1e-6 * np.abs(exact @ exact.T).max() + 1e-6


def test_svd_keeps_small_singular_values(spark, monkeypatch):
    """Singular values over nine orders: a Gram matrix would lose the last ones.  Triangles meet in a tree."""
    from simcat.operators import svd as V
    from simcat.operators.features import FeatureModel
    monkeypatch.setattr(V, "FAN_IN", 2)
    rng = np.random.default_rng(3)
    n, t = 200, 6
    u, _ = np.linalg.qr(rng.standard_normal((n, t)))
    right, _ = np.linalg.qr(rng.standard_normal((t, t)))
    sigma = 10.0 ** -np.array([0, 2, 4, 6, 8, 9])
    a = (u * sigma) @ right.T
    rows = [(i, j, j, float(a[i, j])) for i in range(n) for j in range(t)]
    w = spark.createDataFrame(rows, "product_id int, term int, term_idx int, w double").repartition(7, "product_id")
    model = FeatureModel(weights={}, vocab=[(str(j), 1, 1.0) for j in range(t)], n_docs=n)
    svd = V.fit_svd(w, model, t, Config(svd_power_iters=1))
    c = svd.components
    assert np.abs(c @ c.T - np.eye(t)).max() < 1e-10
    assert np.allclose(np.abs(np.sum(c * right.T, axis=1)), 1, atol=1e-4)
    p = a @ c.T
    assert np.allclose(svd.explained_variance, p.var(axis=0), rtol=1e-6, atol=1e-16)
    assert abs(svd.total_variance - a.var(axis=0).sum()) < 1e-12 and abs(svd.explained_variance_ratio - 1) < 1e-9


def test_svd_of_nothing(spark):
    from simcat.operators.features import FeatureModel
    from simcat.operators.svd import fit_svd
    w = spark.createDataFrame([], "product_id int, term int, term_idx int, w double")
    model = FeatureModel(weights={}, vocab=[("a", 1, 1.0), ("b", 1, 1.0)], n_docs=0)
    svd = fit_svd(w, model, 1, Config())
    assert svd.components.shape == (1, 2) and svd.explained_variance_ratio == 0.0
