"""A dense sixth block: scores, redistribution, and the same rows as keyed vectors give."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from simcat.config import Config
from simcat.operators import dense_block as DB
from simcat.operators import features as FT
from simcat.operators import normalise as N
from simcat.operators import search as S
from simcat.sources.catalog import RAW_COLUMNS
from tests.test_nn_descent import VEC, cloud, vectors
from tests.test_search import shop


def test_dense_vectors_rank_like_keyed_ones(spark):
    df = vectors(spark, cloud(150)).withColumns({"none": F.array().cast("array<string>"),
                                                 "novals": F.array().cast("array<double>")})
    dense = replace(VEC, keys_col="none", vals_col="novals", dense_col="evals")
    rows = lambda d: sorted(map(tuple, d.select("query_id", "rank", "vec_id", "score").collect()))
    want = rows(S.topk_self(df, 5, VEC))
    assert rows(S.topk_self(df, 5, dense)) == want and rows(S.topk_self(df, 5, dense, block_rows=40)) == want
    assert rows(S.topk(df, df, 5, dense, block_rows=60)) == want


def test_shorter_and_missing_vectors_count_as_zeros(spark):
    import pandas as pd
    spec = replace(VEC, dense_col="d")
    a = S._dense_block(pd.DataFrame({"d": [np.array([1.0, 2.0]), None, np.array([3.0])]}), spec)
    assert a.tolist() == [[1.0, 2.0], [0.0, 0.0], [3.0, 0.0]]
    b = S._dense_block(pd.DataFrame({"d": [np.array([1.0]), np.array([2.0])]}), spec)
    assert S._dense_dot(a, b).tolist() == [[1.0, 2.0], [0.0, 0.0], [3.0, 6.0]]


@pytest.fixture(scope="module")
def index(spark):
    schema = "src_seq long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS if c != "src_seq")
    return FT.build_features(N.normalise(spark.createDataFrame(shop(), schema)), Config(tfidf_min_df=1, svd_components=0))


def test_block_weight_and_redistribution(spark, index):
    feats, model = index
    given = spark.createDataFrame([("lamp-1", [3.0, 4.0]), ("lamp-2", [4.0, 3.0]), ("tent-1", [0.0, 0.0]),
                                   ("tent-2", [1.0, None]), ("bare-0", [3.0, 4.0])], "product_id string, vector array<double>")
    six = {r["product_id"]: r for r in DB.with_dense_block(feats, model, given, 1.0).collect()}
    five = {r["product_id"]: r for r in feats.collect()}
    assert six["lamp-1"]["eff_dense"] == pytest.approx(0.5 / (0.5 + 0.5 * sum(
        model.weights[b] for b in model.weights if five["lamp-1"][f"has_{b}"])))
    for p in ("tent-1", "tent-2", "lamp-3"):
        assert six[p]["dense"] is None and six[p]["eff_dense"] == 0.0
        assert six[p]["fvals"] == pytest.approx(five[p]["fvals"])
    for r in six.values():
        norm = sum(v * v for v in r["fvals"]) + sum(v * v for v in r["dense"] or [])
        assert norm == pytest.approx(1.0) or not any(r[f"has_{b}"] for b in (*model.weights, "dense"))
    top = S.similar(DB.with_dense_block(feats, model, given, 1.0), spark.createDataFrame(
        [("lamp-1",)], "product_id string"), 3, DB.DENSE_RANK).where("product_id = 'lamp-2'").first()
    sparse = dict(zip(six["lamp-1"]["fkeys"], six["lamp-1"]["fvals"]))
    want = sum(sparse.get(k, 0.0) * v for k, v in zip(six["lamp-2"]["fkeys"], six["lamp-2"]["fvals"]))
    want += float(np.dot(six["lamp-1"]["dense"], six["lamp-2"]["dense"]))
    assert top["rank"] == 1 and top["score"] == pytest.approx(want, abs=1e-6)
    with pytest.raises(ValueError):
        DB.with_dense_block(feats, model, given, 0.0)
