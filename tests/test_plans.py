"""Physical-plan checks: the shapes that keep the operators scalable."""

import pytest

from simcat.plans.registry import load_all

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_partially_aggregated_before_shuffle(spark):
    from simcat.plans.q_features import products
    p = plan(products(spark, SF))
    assert "WindowGroupLimit" in p and "row_number(), 1, Partial" in p
    assert p.index("row_number(), 1, Partial") > p.index("Exchange hashpartitioning(product_id")


def test_basket_scan_is_pruned(spark):
    from simcat.plans.q_search import basket_ids
    p = plan(basket_ids(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "TakeOrderedAndProject" in p


def test_blocked_search_shape(spark):
    from simcat.operators import search as S
    from simcat.plans.q_features import built
    f, _ = built(spark, SF)
    p = plan(S.topk(f, f, 10))
    assert "MapInPandas" in p and "FlatMapCoGroupsInPandas" not in p
    assert "WindowGroupLimit" in p and "Partial" in p
    p3 = plan(S.topk_self(f, 10, block_rows=64))
    assert "FlatMapGroupsInPandas" in p3 and "WindowGroupLimit" in p3


def test_no_cartesian_products_or_row_udfs(spark):
    """Every registered query: no cartesian product, no nested-loop join, no per-row Python UDF."""
    bad = {}
    for name, q in load_all().items():
        p = plan(q.build(spark, SF))
        hits = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                            "ArrowEvalPython") if w in p]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_result_types_match_oracle(spark):
    """Spark result types equal the DuckDB oracle's column types for every SQL-backed query."""
    from tests.harness import duck_connection
    con = duck_connection(SF)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    bad = {}
    for name, q in load_all().items():
        if not q.sql:
            continue
        st = {f.name: same.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in q.build(spark, SF).schema.fields}
        rel = con.sql(q.sql)
        dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
        if st != dt:
            bad[name] = (st, dt)
    assert bad == {}
