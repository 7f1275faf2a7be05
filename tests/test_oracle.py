"""Registered queries against their DuckDB SQL on the smallest scale factor."""

import os

import pytest

from tests.harness import compare, duck_connection

SF = "/root/testdata/sf0.001"
FAST = ["parse_price", "parse_weight", "parse_rating", "category_key", "normalise", "null_report",
        "value_topn", "text_lengths", "numeric_block", "effective_weights", "tfidf", "topk_exact",
        "knn_embeddings", "product_lookup", "unknown_ids", "contains_ids", "filter_valid_id",
        "malformed_count", "scan_ldjson", "topk_ann_all_cells"]


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def _names():
    """A quick choice, or with SIMCAT_ALL_ORACLE set every query that has SQL."""
    from simcat.plans.registry import load_all
    return [n for n, q in load_all().items() if q.sql] if os.environ.get("SIMCAT_ALL_ORACLE") else FAST


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from simcat.plans.registry import load_all
    q = load_all()[name]
    sp = q.build(spark, SF).toPandas()
    dk = duck.execute(q.sql).df()
    assert compare(sp, dk) is None
