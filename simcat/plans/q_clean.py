"""Projection, filter and dedup queries on the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from simcat.operators import normalise as N
from simcat.plans import oracle as O
from simcat.plans.registry import register
from simcat.sources import catalog_raw

_CANON = list(N.COLUMN_MAP.items())


@register("project_canonical", lambda: O.with_views(
    "SELECT src_seq, " + ", ".join(f"{s} AS {d}" for s, d in _CANON) + " FROM catalog_raw"))
def q_project_canonical(spark, sf_dir):
    return N.project_canonical(catalog_raw(spark, sf_dir))


@register("filter_valid_id", lambda: O.with_views(
    "SELECT product_id, src_seq FROM (" + O.cleaned_sql() + ") c "
    "WHERE product_id IS NOT NULL AND product_id <> ''"))
def q_filter_valid_id(spark, sf_dir):
    c = N.clean_columns(N.project_canonical(catalog_raw(spark, sf_dir)))
    return N.filter_valid_id(c).select("product_id", "src_seq")


@register("dedup_first", lambda: O.with_views(
    "SELECT product_id, src_seq, product_name FROM products"))
def q_dedup_first(spark, sf_dir):
    return N.normalise(catalog_raw(spark, sf_dir)).select("product_id", "src_seq", "product_name")


_NUM = ["sales_price", "rating", "discount_percentage", "weight_grams", "sales_rank", "list_price",
        "is_prime", "is_best_seller"]
_STR = ["product_id", "product_name", "brand", "browsenode", "child_category", "parent_category",
        "text", "image_url"]


@register("normalise", lambda: O.with_views(
    "SELECT " + ", ".join(_STR) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in _NUM)
    + ", array_to_string(colour_tokens, '|') AS colour_tokens, src_seq FROM products"))
def q_normalise(spark, sf_dir):
    p = N.normalise(catalog_raw(spark, sf_dir))
    return p.select(*_STR, *[F.round(c, 6).alias(c) for c in _NUM],
                    F.array_join("colour_tokens", "|").alias("colour_tokens"), "src_seq")


_SCAN = ["uniq_id", "product_name", "brand", "sales_price", "sales_rank_in_child_category"]


@register("scan_ldjson", lambda: O.with_views(
    "SELECT " + ", ".join(_SCAN) + " FROM catalog_raw WHERE src_seq % 37 <> 0"))
def q_scan_ldjson(spark, sf_dir):
    """The catalogue written as JSON lines and scanned again.

    Every 37th line is cut short; blank and tab-only lines stand between the records.
    """
    import os
    import uuid

    from simcat.plans.memo import memo
    from simcat.session import ensure_checkpoint_dir
    from simcat.sources.ldjson import scan_ldjson

    def write():
        path = os.path.join(ensure_checkpoint_dir(spark), f"lines-{uuid.uuid4().hex}")
        raw = catalog_raw(spark, sf_dir)
        record = F.to_json(F.struct(*[c for c in raw.columns if c != "src_seq"]))
        line = F.when(F.col("src_seq") % 37 == 0, F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(
            F.concat(F.lit("\t"), record, F.lit(" \t")))
        raw.select(F.explode(F.array(line, F.lit("\t\t"), F.lit(""))).alias("value")).write.text(path)
        return path
    path = memo(spark, ("lines", sf_dir), write)
    return scan_ldjson(spark, path, _SCAN).select(*_SCAN)
