"""``catalog_raw``: a messy product catalogue derived row by row from ``part``.

The original input is a line-delimited JSON dump of retail products whose
fields are free-form text.  The driver's tables hold no such dump, so this view
writes ``part`` out in that shape: prices with thousands separators and ranges,
weights with units or a sentinel, ratings as prose, stringified dicts for the
sales-rank columns, pipe-separated colours, Y/N flags with stray spaces and a
few exact re-listings (same id, later position) for the keep-first dedup, and
rows that hold nothing but an id, or a null or blank one.

It is a projection plus one UNION ALL: no shuffle, and its size grows with
``part``.  The same rules are written as DuckDB SQL in ``simcat.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simcat.sources.tables import read_table

# Raw column names of the catalogue dump (all strings) plus src_seq, the file
# position used by keep-first rules.
RAW_COLUMNS = [
    "src_seq", "uniq_id", "product_name", "brand", "colour", "sales_price", "weight",
    "rating", "discount_percentage", "browsenode", "meta_keywords", "medium",
    "sales_rank_in_child_category", "sales_rank_in_parent_category",
    "amazon_prime__y_or_n", "best_seller_tag__y_or_n", "no__of_reviews", "asin",
    "image_urls__small", "large", "parent___child_category__all", "product_details__k_v_pairs",
]

# Places per part key: the record, its re-listed copy, its bare row.
PLACES = 3


def _s(c: Column) -> Column:
    return c.cast("string")


def _rules(name: Column) -> list[Column]:
    k = F.col("p_partkey")
    m = lambda n: k % n
    price = F.col("p_retailprice").cast("decimal(12,2)")
    price_txt = _s(price)
    price5_txt = _s((price + F.lit(5)).cast("decimal(12,2)"))
    k3 = F.lpad(_s(m(1000)), 3, "0")
    first_word = F.substring_index(F.col("p_name"), " ", 1)
    return [
        (k * PLACES).alias("src_seq"),
        _s(k).alias("uniq_id"),
        name.alias("product_name"),
        F.when(m(4) == 0, F.lit(None).cast("string"))
         .when(m(29) == 0, F.lit(" N/A "))
         .otherwise(F.concat(F.lit(" "), F.col("p_brand"))).alias("brand"),
        F.when(m(5) == 0, F.concat(first_word, F.when(m(2) == 0, F.lit("|Black| "))
                                   .otherwise(F.lit("|White|Black"))))
         .alias("colour"),
        F.when(m(11) == 0, F.lit(None).cast("string"))
         .when(m(13) == 0, F.concat(F.lit("$"), price_txt, F.lit(" - $"), price5_txt))
         .when(m(7) == 0, F.concat(F.lit("1,"), k3, F.lit(".00")))
         .otherwise(price_txt).alias("sales_price"),
        F.when(m(20) == 0, F.concat(_s(F.col("p_size")), F.lit(" g")))
         .when(m(20) == 5, F.lit("1.5 kg"))
         .when(m(20) == 10, F.lit("3.2 ounces"))
         .when(m(20) == 15, F.lit("500"))
         .otherwise(F.lit("999999999")).alias("weight"),
        F.when(m(41) == 0, F.lit("11.0"))
         .when(m(3) == 0, F.concat(_s(m(5)), F.lit(".5 out of 5 stars")))
         .otherwise(F.concat(_s(m(5) + 1), F.lit(".0"))).alias("rating"),
        F.when(m(8) == 0, F.lit(None).cast("string"))
         .when(m(19) == 0, F.lit("150"))
         .when(m(2) == 0, F.concat(_s(m(9) * 10), F.lit("%")))
         .otherwise(_s(m(9) * 10)).alias("discount_percentage"),
        F.when(m(50) == 3, F.lit(None).cast("string")).otherwise(F.col("p_type"))
         .alias("browsenode"),
        F.when(m(10) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"))).alias("meta_keywords"),
        F.concat(F.lit("https://Img.example/"), _s(k), F.lit(".jpg|https://Img.example/b.jpg"))
         .alias("medium"),
        F.when(m(6) == 0, F.lit(None).cast("string"))
         .when(m(61) == 0, F.lit("not a dict"))
         .otherwise(F.concat(F.lit("{'Cat"), _s(m(12)), F.lit("': '#1,"), k3, F.lit("'}")))
         .alias("sales_rank_in_child_category"),
        F.when(m(9) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("{'Top': '#19,259', 'Par"), _s(m(3)), F.lit("': '#12'}")))
         .alias("sales_rank_in_parent_category"),
        F.when(m(4) == 1, F.lit(" y ")).when(m(4) == 2, F.lit(None).cast("string"))
         .otherwise(F.lit("N")).alias("amazon_prime__y_or_n"),
        F.when(m(25) == 0, F.lit("Y")).otherwise(F.lit("N")).alias("best_seller_tag__y_or_n"),
        F.when(m(9) == 0, F.concat(_s(m(300)), F.lit(" ratings"))).alias("no__of_reviews"),
        F.when(m(33) != 0, F.concat(F.lit("A"), _s(F.floor(k / 2).cast("bigint")))).alias("asin"),
        F.when(m(3) != 0, F.concat(F.lit("https://Img.example/s/"), _s(k), F.lit(".jpg")))
         .alias("image_urls__small"),
        F.when(m(4) == 1, F.lit("  ")).otherwise(F.concat(F.lit("https://Img.example/l/"), _s(k)))
         .alias("large"),
        F.when(m(7) != 0, F.concat(F.col("p_type"), F.lit(" > "), F.col("p_brand")))
         .alias("parent___child_category__all"),
        F.when(m(5) != 1, F.concat(F.lit("{'Size': '"), _s(F.col("p_size")), F.lit("', 'Kind': '"),
                                   F.col("p_type"), F.lit("'}"))).alias("product_details__k_v_pairs"),
    ]


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``part`` rows as raw catalogue records, re-listed copies of every 50th key, bare rows of every 40th."""
    from simcat.plans.memo import memo
    return memo(spark, ("catalog_raw", sf_dir), lambda: _catalog_raw(spark, sf_dir))


def _catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", spread=True).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    name = F.when(k % 17 == 0, F.concat(F.col("p_name"), F.lit(" https://x.example/"), _s(k))) \
            .otherwise(F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")))
    base = part.select(*_rules(name))
    copies = (part.where(k % 50 == 0)
              .select(*_rules(F.concat(F.col("p_name"), F.lit(" copy"))))
              .withColumn("src_seq", F.col("src_seq") + 1))
    # records with nothing but an id, and ids that are null or blank
    uniq_id = (F.when(k % 120 == 0, F.lit(None).cast("string")).when(k % 80 == 0, F.lit("   "))
               .otherwise(F.concat(F.lit("bare"), _s(k))))
    bare = part.where(k % 40 == 0).select(
        (k * PLACES + 2).alias("src_seq"), uniq_id.alias("uniq_id"),
        *[F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c not in ("src_seq", "uniq_id")])
    return base.unionByName(copies).unionByName(bare)
