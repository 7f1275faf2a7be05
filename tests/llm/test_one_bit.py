"""Hard negatives against brute force; intervals that hold for certain."""

import math

import numpy as np
import pytest

from simcat.llm import one_bit as O

SCHEMA = "vec_id long, embedding array<float>, label int, row string"


def brute(rows, every=100, k_pos=5, k_neg=10):
    kept = []
    for n, (i, v, lab) in enumerate(rows):
        if lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        kept.append((n, i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, i, lab, v in kept:
        if i is None or i % every:
            continue
        order = lambda c: (-c[0], c[1] is None, c[1] or 0)
        same = sorted([(dot(v, w), j) for m, j, l2, w in kept if m != n and l2 == lab], key=order)[:k_pos]
        other = sorted([(dot(v, w), j) for m, j, l2, w in kept if l2 != lab], key=order)
        for ps, p in same:
            near = [(s, j) for s, j in other if 30 * ps <= 100 * s <= 90 * ps][:k_neg]
            out += [(i, p, r + 1, j, ps, s) for r, (s, j) in enumerate(near)]
    return sorted(out, key=repr)


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], SCHEMA).coalesce(1)
    return sorted(map(tuple, O.mine(df.repartition(parts) if parts > 1 else df, **kw).collect()), key=repr)


def cloud(n, dims=64, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dims)
    return [(i, (centre + spread * 3 * rng.standard_normal(dims)).tolist(), int(rng.integers(0, 10))) for i in range(n)]


@pytest.mark.parametrize("dims", [5, 64, 100])
def test_equals_brute_force(spark, dims):
    rows = cloud(600, dims)
    want = brute(rows)
    assert len(want) > 100 and run(spark, rows) == want


def test_small_pieces_and_chunks(spark, monkeypatch):
    rows = cloud(700, 64, 3)
    want = brute(rows, every=20)
    monkeypatch.setattr(O, "ROWS", 50)
    monkeypatch.setattr(O, "ANCHORS", 4)
    assert run(spark, rows, every=20, chunk=7) == want


def test_edges(spark):
    v = [0.5, -0.25, 0.125]
    rows = [(0, v, 1), (100, v, 2), (1, v, 1), (2, v, 2), (3, [0.5, float("nan"), 0.1], 1), (4, None, 1),
            (5, [0.5, None, 0.1], 2), (6, v, None), (None, [0.3, -0.2, 0.1], 2), (8, [float("inf"), 0.0, 0.0], 1),
            (9, [0.2, -0.1, 0.1], 1), (10, [0.2, -0.1, 0.1], 2), (11, [0.2], 1), (12, [], 2), (14, v, 0),
            (13, [0.0, 0.0, 0.0], 1), (200, [0.0, 0.0, 0.0], 4), (300, v, 6)]
    got = run(spark, rows, 1)
    assert got and got == brute(rows)


def test_a_hot_label_and_repeated_vectors(spark):
    rows = [(i, v, 3 if i % 3 else lab) for i, v, lab in cloud(600, 64, 5)]
    rows += [(i + 600, rows[i % 10][1], 4) for i in range(200)]
    assert run(spark, rows, 4) == brute(rows)


def test_rows_that_share_an_id_are_different_rows(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.5], 1), (1, [0.5, 0.0], 2), (2, [0.5, 0.1], 2)]
    assert run(spark, rows, 1) == brute(rows)


def test_empty_and_no_anchor(spark):
    assert run(spark, [], 1) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)], 1) == []


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4])
def test_intervals_hold_and_filter(scale):
    rng = np.random.default_rng(2)
    v = np.floor(256 * scale * rng.standard_normal((500, 128)))
    v[7] = 0
    turn = O.rotation(128)
    assert np.allclose(turn @ turn.T, np.eye(128))
    code, align, residual, length = O.encode(v, turn)
    q = {"length": length} | O.planes_of(v @ turn.T)
    low, high = O.intervals(q, slice(0, 60), code.view("<u8"), align, residual, length)
    true = v[:60] @ v.T
    assert (low <= true).all() and (true <= high).all()
    wide = np.outer(length[:60], length)
    assert np.median((high - low)[wide > 0] / wide[wide > 0]) < 1.35       # a trivial bound gives 2
