"""Exact dedup: against a plain dictionary, over edge cases, and through several merge rounds."""

import hashlib
from collections import defaultdict

import pytest

from simcat.llm import digest_merge as D
from simcat.llm.common import LOWER_TABLE, materialise
from pyspark.sql import functions as F

ROWS = [(1, "Same text"), (2, "same TEXT"), (3, None), (4, ""), (5, "other"), (6, "ÀB"), (7, "àb"),
        (8, "same text"), (8, "same text"), (None, "other"), (9, "x" * 300_000)]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER_TABLE)].append(i)
    out = []
    for i, t in rows:
        norm = (t or "").translate(LOWER_TABLE)
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows],
                                 "doc_id long, text string, digest string").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_equals_dictionary(spark, parts):
    got = D.dedup(docs_of(spark, ROWS, parts)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)


def test_hot_group_and_many_runs(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    got = D.dedup(docs_of(spark, rows, 70)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_merge_keeps_texts_apart_whose_checks_differ(spark):
    rows = [(0, 0, bytearray(b"d"), 1, 10, 5, 1), (0, 1, bytearray(b"d"), 1, 10, 7, 2),
            (0, 2, bytearray(b"d"), 2, 10, 9, 1)]
    got = D.merge_runs(spark.createDataFrame(rows, D.RUN_SCHEMA), 3).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in got) == [(7, 3), (9, 1)]


def test_empty_table_and_filter(spark):
    empty = docs_of(spark, ROWS).limit(0)
    assert D.dedup(empty).count() == 0
    kept = D.filter_documents(docs_of(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "digest"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 8, 9]
    assert D.filter_documents(empty).count() == 0


def test_materialised_table_is_read_back(spark):
    assert materialise(spark.range(5).select(F.col("id")), "t").count() == 5


def test_multiway_merge_of_sorted_runs():
    import numpy as np
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 8):
        runs, want = [], {}
        for _ in range(k):
            keys = sorted({bytes([x]) * 47 + b"\1" for x in rng.integers(1, 40, 30).tolist()})
            ids, sizes = rng.integers(-9, 99, len(keys)), rng.integers(1, 5, len(keys))
            runs.append((np.array(keys, D.KEY), ids, sizes))
            for key, i, n in zip(keys, ids.tolist(), sizes.tolist()):
                best, total = want.get(key, (i, 0))
                want[key] = max(best, i), total + n
        got = D.merge_sorted(runs)
        assert got[0].tolist() == sorted(want)
        assert list(zip(*(c.tolist() for c in got[1:]))) == [want[key] for key in sorted(want)]


def test_groups_of_a_round_follow_the_rows():
    for n in (10 ** 6, 10 ** 9, 10 ** 11):
        for runs, bits in D.cuts(n, max(1, n // 2_000_000), 8):
            groups = -(-runs // D.FAN_IN) << bits
            assert n / D.RANGE_ROWS <= max(groups, 8) and groups <= 2 * max(n / D.RANGE_ROWS, 8, -(-runs // D.FAN_IN))


def test_names_of_helpers_are_free_for_the_caller(spark):
    docs = docs_of(spark, ROWS).withColumns({"key": F.lit("mine"), "sha": F.lit("x"), "_key": F.lit("own"),
                                             "row": F.lit(1)})
    kept = D.filter_documents(docs)
    assert kept.columns == docs.columns
    assert {(r["key"], r["sha"], r["_key"], r["row"]) for r in kept.collect()} == {("mine", "x", "own", 1)}


def test_rows_that_repeat_the_kept_id_are_all_kept(spark):
    docs = docs_of(spark, [(5, "a"), (5, "A"), (5, "a"), (4, "a")])
    assert sorted((r["doc_id"], r["kept"]) for r in D.dedup(docs).collect()) == [
        (4, False), (5, True), (5, True), (5, True)]
    assert D.filter_documents(docs).count() == 1


@pytest.mark.parametrize("runs", [1, 3, 20, 70])
def test_the_last_merge_needs_one_python_worker(spark, runs):
    rows = [(0, i % runs, bytes([i % 50]) * 32, 1, 10, i, 1) for i in range(300)]
    merged = D.merge_runs(spark.createDataFrame(rows, D.RUN_SCHEMA), runs)
    after = merged._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert after.count("InArrow") + after.count("InPandas") == 1
    got = merged.collect()
    assert len(got) == 50 and sum(r["group_size"] for r in got) == 300
    assert all(r["keep_id"] == 250 + r["digest"][0] for r in got)
