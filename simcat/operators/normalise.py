"""Raw catalogue -> tidy product table (one projection and one keep-first dedup)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simcat.functions import parsers as P

# Source column -> canonical name.
COLUMN_MAP = {
    "uniq_id": "product_id",
    "product_name": "product_name",
    "brand": "brand",
    "colour": "colour",
    "sales_price": "sales_price",
    "weight": "weight_raw",
    "rating": "rating",
    "discount_percentage": "discount_percentage",
    "browsenode": "browsenode",
    "meta_keywords": "meta_keywords",
    "medium": "image_url_raw",
    "sales_rank_in_child_category": "child_category_raw",
    "sales_rank_in_parent_category": "parent_category_raw",
    "amazon_prime__y_or_n": "prime_raw",
    "best_seller_tag__y_or_n": "best_seller_raw",
}

PRODUCT_COLUMNS = [
    "product_id", "product_name", "brand", "sales_price", "rating", "discount_percentage",
    "browsenode", "weight_grams", "sales_rank", "list_price", "child_category",
    "parent_category", "colour_tokens", "text", "is_prime", "is_best_seller", "image_url",
]


def project_canonical(raw: DataFrame) -> DataFrame:
    """Rename the source columns; an absent source column becomes an all-null string."""
    cols = [(F.col(src) if src in raw.columns else F.lit(None).cast("string")).alias(dst)
            for src, dst in COLUMN_MAP.items()]
    if "src_seq" not in raw.columns:
        raise ValueError("raw records need src_seq, their position: the first row of an id is kept")
    return raw.select(*cols, "src_seq")


def clean_columns(canonical: DataFrame, weight_sentinel: float = 1_000_000.0) -> DataFrame:
    """Typed, cleaned columns (no row removal).

    Two projections: parsed values that later columns reuse (price, discount,
    the dict maps) are computed once in the first and referenced in the second.
    """
    staged = canonical.select(
        "*",
        P.parse_price("sales_price").alias("_price"),
        P.parse_percentage("discount_percentage").alias("_disc"),
        P.parse_dict("child_category_raw").alias("_child"),
        P.parse_dict("parent_category_raw").alias("_parent"))
    price, disc = F.col("_price"), F.col("_disc")
    return staged.select(
        P.strip(F.col("product_id")).alias("product_id"),
        F.coalesce(F.col("product_name"), F.lit("")).alias("product_name"),
        P.clean_categorical("brand").alias("brand"),
        price.alias("sales_price"),
        P.parse_rating("rating").alias("rating"),
        disc.alias("discount_percentage"),
        P.clean_categorical("browsenode").alias("browsenode"),
        P.parse_weight("weight_raw", weight_sentinel).alias("weight_grams"),
        P.category_rank(F.col("_child"), parsed=True).alias("sales_rank"),
        P.list_price(price, disc).alias("list_price"),
        P.category_key(F.col("_child"), parsed=True).alias("child_category"),
        P.category_key(F.col("_parent"), parsed=True).alias("parent_category"),
        P.split_multi("colour").alias("colour_tokens"),
        P.text_concat("product_name", "meta_keywords").alias("text"),
        P.yn_flag("prime_raw").alias("is_prime"),
        P.yn_flag("best_seller_raw").alias("is_best_seller"),
        P.first_of_multi("image_url_raw").alias("image_url"),
        F.col("src_seq"),
    )


def filter_valid_id(df: DataFrame) -> DataFrame:
    """Drop rows whose id is null or blank after strip."""
    return df.where(F.col("product_id").isNotNull() & (F.col("product_id") != ""))


def dedup_first(df: DataFrame, key: str = "product_id", order: str = "src_seq") -> DataFrame:
    """Keep the first row per key in source order.

    ``row_number() = 1`` per key: Catalyst plans it as a partial group limit
    (``WindowGroupLimit ... Partial``) inside each map task, then the shuffle on
    the key, then the final limit.  A key with millions of copies (a third of the
    table) therefore sends one row per map task, never the whole group.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def normalise(raw: DataFrame, weight_sentinel: float = 1_000_000.0,
              keep_seq: bool = True) -> DataFrame:
    """Full cleaning: rename, parse, drop id-less rows, keep the first row per id.

    Parsing runs where the rows are (no shuffle); the only shuffle is the
    keep-first window on the id, which leaves the table hash-partitioned by
    ``product_id`` for the per-product aggregations that follow.
    """
    out = dedup_first(filter_valid_id(clean_columns(project_canonical(raw), weight_sentinel)))
    cols = PRODUCT_COLUMNS + (["src_seq"] if keep_seq else [])
    return out.select(*cols)
