"""Weights per request: the same rows as an index rebuilt with those weights."""

import pytest
from pyspark.sql import functions as F

from simcat.config import BLOCKS, Config
from simcat.operators import features as FT
from simcat.operators import normalise as N
from simcat.operators import search as S
from simcat.operators import weighted as W
from simcat.sources.catalog import RAW_COLUMNS
from tests.test_search import rows_of, shop

SCHEMA = "src_seq long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS if c != "src_seq")
SETS = {"a": dict(zip(BLOCKS, (0.35, 0.30, 0.20, 0.10, 0.05))), "b": dict(zip(BLOCKS, (0.0, 5.0, 1.0, 0.0, 2.0)))}


@pytest.fixture(scope="module")
def products(spark):
    from simcat.session import materialise
    return materialise(N.normalise(spark.createDataFrame(shop(), SCHEMA)))


@pytest.fixture(scope="module")
def index(products):
    return FT.build_features(products, Config(tfidf_min_df=1))


def requests_of(spark, rows):
    return spark.createDataFrame(rows, "request_id string, product_id string, "
                                 + ", ".join(f"{b} double" for b in BLOCKS))


@pytest.mark.parametrize("svd, block_rows", [(0, 2048), (256, 5)])
def test_two_weight_sets_equal_two_rebuilt_indexes(spark, products, svd, block_rows):
    feats, model = FT.build_features(products, Config(tfidf_min_df=1, svd_components=svd))
    ids = ["lamp-1", "tent-3", "bare-0"]
    asked = requests_of(spark, [(f"{s}/{i}", i, *[w[b] for b in BLOCKS]) for s, w in SETS.items() for i in ids])
    got = W.search_weighted(feats, model, asked, 7, block_rows=block_rows)
    for s, w in SETS.items():
        rebuilt, _ = FT.build_features(products, Config(tfidf_min_df=1, svd_components=svd, weights=w))
        want = S.similar(rebuilt, spark.createDataFrame([(i,) for i in ids], "product_id string"), 7)
        mine = got.where(F.col("request_id").startswith(f"{s}/")).drop("request_id")
        assert rows_of(mine) == rows_of(want)
    assert got.columns[:5] == ["request_id", "query_id", "rank", "product_id", "score"]


def test_one_product_asked_twice_and_ids_trimmed(spark, index):
    feats, model = index
    got = W.search_weighted(feats, model, requests_of(spark, [
        ("x", " lamp-1 ", 1.0, 0.0, 0.0, 0.0, 0.0), ("y", "lamp-1", 0.0, 0.0, 1.0, 0.0, 0.0),
        ("z", "nobody", 1.0, 1.0, 1.0, 1.0, 1.0)]), 3)
    assert {(r["request_id"], r["query_id"], r["rank"]) for r in got.collect()} == {
        (q, "lamp-1", n) for q in "xy" for n in (1, 2, 3)}


def test_missing_weights_take_the_models(spark, index):
    feats, model = index
    asked = requests_of(spark, [("n", "tent-1", None, None, None, None, None)])
    want = rows_of(S.similar(feats, spark.createDataFrame([("tent-1",)], "product_id string"), 5))
    assert rows_of(W.search_weighted(feats, model, asked, 5)) == want
    assert rows_of(W.search_weighted(feats, model, asked.select("request_id", "product_id"), 5)) == want


def test_invalid_requests(spark, index):
    feats, model = index
    asked = requests_of(spark, [("neg", "lamp-1", -1.0, 2.0, 1.0, 1.0, 1.0), ("zero", "lamp-1", 0.0, 0.0, 0.0, 0.0, 0.0),
                                ("nan", "lamp-1", float("nan"), 1.0, 1.0, 1.0, 1.0),
                                ("inf", "lamp-1", float("inf"), 1.0, 1.0, 1.0, 1.0),
                                ("ok", "lamp-1", 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert {r["request_id"] for r in W.invalid_requests(asked, model).collect()} == {"neg", "zero", "nan", "inf"}
    assert {r["request_id"] for r in W.search_weighted(feats, model, asked, 2).collect()} == {"ok"}


def test_no_requests_and_k_zero(spark, index):
    feats, model = index
    none = requests_of(spark, [])
    assert W.search_weighted(feats, model, none, 5).count() == 0
    assert W.search_weighted(feats, model, requests_of(spark, [("a", "lamp-1", 1.0, 1.0, 1.0, 1.0, 1.0)]), 0).count() == 0
