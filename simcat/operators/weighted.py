"""Block weights per request: every request is scored under weights of its own, on one index.

With presence flags ``p_i`` and weights ``w`` a row's effective weight of block i is
``p_i * w_i / S(w)``, ``S(w) = sum_j p_j * w_j``, so the score of query a and candidate b becomes

    score(a, b; w) = sum_i w_i * cos_i(a, b) / sqrt(S_a(w) * S_b(w))

(cos_i is 0 where either side lacks the block).  The index therefore keeps unit blocks and presence
flags only.  A request's weights multiply its own side, block by block; what a candidate's missing
blocks hand on follows from its flags and the request's weights at query time.  Two weight sets in
one job give what two rebuilt indexes would give, and nothing is refitted or rewritten.

Requests are a table (request_id, product_id, one column per block).  They are scored in chunks like
other requests (``search.in_chunks``); the corpus is never exchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simcat.config import BLOCKS
from simcat.functions.parsers import strip
from simcat.operators import features as FT
from simcat.operators import search as S
from simcat.operators.search import PRODUCT_RANK, RankSpec

# First letter of a feature key -> position of its block in BLOCKS (text has two forms).
KEY_LETTERS, KEY_BLOCKS = "ctsnbo", "011234"


def block_features(feats: DataFrame, model: FT.FeatureModel) -> DataFrame:
    """``feats`` with ``bkeys``/``bvals`` (unit blocks, no weights) and ``present`` (5 flags)."""
    has = {b: F.col(f"has_{b}").cast("double") for b in BLOCKS}
    return (FT.with_feature_list(feats, model, has, "bkeys", "bvals")
            .withColumn("present", F.array(*[has[b] for b in BLOCKS])))


def weights_of(requests: DataFrame, model: FT.FeatureModel) -> Column:
    """A request's weights in block order; a missing column or null takes the model's weight."""
    return F.array(*[F.coalesce(F.col(b).cast("double") if b in requests.columns else F.lit(None),
                                F.lit(float(model.weights[b]))) for b in BLOCKS])


def _valid(w: Column) -> Column:
    fine = F.forall(w, lambda x: ~F.isnan(x) & (x >= 0) & (x < F.lit(float("inf"))))
    return fine & (F.aggregate(w, F.lit(0.0), lambda s, x: s + x) > 0)


def invalid_requests(requests: DataFrame, model: FT.FeatureModel) -> DataFrame:
    """Requests that can't be scored: a weight below 0 or not finite, or no weight above 0."""
    return requests.where(~_valid(weights_of(requests, model)))


def _requests(requests: DataFrame, indexed: DataFrame, model: FT.FeatureModel, spec: RankSpec) -> DataFrame:
    """Request id, product id, hashed keys, values times the block's weight, weights and S of the product."""
    asked = requests.select("request_id", strip(F.col(spec.id_col)).alias(spec.id_col),
                            weights_of(requests, model).alias("w")).where(_valid(F.col("w")))
    own = indexed.select(F.col(spec.id_col).alias(spec.id_col), "bkeys", "bvals", "present")
    block = lambda k: F.translate(F.substring(k, 1, 1), KEY_LETTERS, KEY_BLOCKS).cast("int")
    scaled = F.zip_with("bkeys", "bvals", lambda k, v: v * F.element_at("w", block(k) + 1))
    total = F.aggregate(F.zip_with("present", "w", lambda p, w: p * w), F.lit(0.0), lambda s, x: s + x)
    return asked.join(own, spec.id_col).select(
        "request_id", spec.id_col, F.transform("bkeys", lambda k: F.xxhash64(k)).alias(spec.keys_col),
        scaled.alias(spec.vals_col), "w", total.alias("total"))


class Prepared:
    """A chunk of requests, made dense once and scored against many candidate batches."""

    def __init__(self, q: pd.DataFrame, spec: RankSpec):
        self.q, self.spec = q, spec
        self.vocab = S._vocab(q, spec=spec)
        self.x = S._dense(q, self.vocab, spec)
        self.w = np.stack(q["w"].values).astype(np.float64)
        self.total = q["total"].to_numpy(dtype=np.float64)
        self.names = q["request_id"].to_numpy()

    def topk(self, c: pd.DataFrame, k: int) -> pd.DataFrame:
        own = self.w @ np.stack(c["present"].values).astype(np.float64).T     # S of the candidates
        norm = np.sqrt(self.total[:, None] * own)
        dot = self.x @ S._dense(c, self.vocab, self.spec).T
        score = np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0)
        return S.select_topk(np.round(score, self.spec.score_places), self.q, c, k, self.spec, self.names)


def search_weighted(feats: DataFrame, model: FT.FeatureModel, requests: DataFrame, k: int = 10,
                    spec: RankSpec = PRODUCT_RANK, block_rows: int = S.BLOCK_ROWS) -> DataFrame:
    """Exact top-k for every request under its own weights.

    ``requests`` has unique ``request_id`` s, the product id (trimmed) and any of the columns
    ``category, text, numeric, brand, colour``.  Returns (request_id, query_id, rank, product_id,
    score, carried columns).  Unknown products and ``invalid_requests`` give no rows.
    """
    indexed = block_features(feats, model)
    asked = _requests(requests, indexed, model, spec)
    id_type = requests.schema["request_id"].dataType.simpleString()
    schema = S._result_schema(spec).replace(f"query_id {spec.id_type}", f"query_id {id_type}", 1)
    cand = indexed.select(F.col(spec.id_col).alias(spec.id_col),
                          F.transform("bkeys", lambda key: F.xxhash64(key)).alias(spec.keys_col),
                          F.col("bvals").alias(spec.vals_col), "present",
                          *[F.col(c).cast("double").alias(c) for c, _, _ in spec.tiebreak])

    def finish(shared):
        def score(batches):
            prepared, best = Prepared(shared.value, spec), None
            for pdf in batches:
                for start in range(0, len(pdf), block_rows):
                    part = prepared.topk(pdf.iloc[start:start + block_rows], k)
                    best = part if best is None else S.merge_topk(best, part, k, spec)
            if best is not None and len(best):
                yield best
        return S.rank_final(cand.mapInPandas(score, schema), k, spec)

    ranked = S.in_chunks(asked, "request_id", finish, block_rows) if k > 0 else None
    if ranked is None:
        ranked = feats.sparkSession.createDataFrame([], f"{schema}, rank long")
    out = S.with_columns(ranked, feats, spec).withColumnRenamed("query_id", "request_id")
    names = asked.select("request_id", F.col(spec.id_col).alias("query_id"))
    return out.join(names, "request_id").select("request_id", "query_id", *out.columns[1:])
