"""Scalar-function queries: one row per raw record, raw text next to its parse."""

from __future__ import annotations

from pyspark.sql import functions as F

from simcat.functions import parsers as P
from simcat.functions import text as TX
from simcat.functions import vectors as V
from simcat.plans import oracle as O
from simcat.plans.registry import register
from simcat.sources import catalog_raw, read_table


def _scalar(name: str, column: str, spark_fn, sql_fn):
    sql = O.with_views(
        f"SELECT src_seq, uniq_id, {column} AS raw, {sql_fn(column)} AS value FROM catalog_raw")

    @register(name, sql)
    def build(spark, sf_dir):
        return catalog_raw(spark, sf_dir).select(
            "src_seq", "uniq_id", F.col(column).alias("raw"), spark_fn(column).alias("value"))
    return build


_scalar("is_missing", "brand", P.is_missing, O.is_missing)
_scalar("parse_price", "sales_price", P.parse_price, O.parse_price)
_scalar("parse_price_lenient", "sales_price",
        lambda c: P.parse_price(c, lenient=True), lambda c: O.parse_price(c, lenient=True))
_scalar("parse_weight", "weight", P.parse_weight, O.parse_weight)
_scalar("parse_weight_lenient", "weight",
        lambda c: P.parse_weight(c, lenient=True), lambda c: O.parse_weight(c, lenient=True))
_scalar("parse_rating", "rating", P.parse_rating, O.parse_rating)
_scalar("parse_rating_lenient", "rating",
        lambda c: P.parse_rating(c, lenient=True), lambda c: O.parse_rating(c, lenient=True))
_scalar("parse_percentage", "discount_percentage", P.parse_percentage, O.parse_percentage)
_scalar("category_key", "sales_rank_in_child_category", P.category_key, O.category_key)
_scalar("category_key_parent", "sales_rank_in_parent_category", P.category_key, O.category_key)
_scalar("category_rank", "sales_rank_in_child_category", P.category_rank, O.category_rank)
_scalar("first_of_multi", "medium", P.first_of_multi, O.first_of_multi)
_scalar("clean_text", "product_name", P.clean_text, O.clean_text)
_scalar("clean_categorical", "brand", P.clean_categorical, O.clean_categorical)
_scalar("yn_flag", "amazon_prime__y_or_n", P.yn_flag, O.yn_flag)
_scalar("to_number", "rating", P.to_number, O.to_number)
_scalar("review_count", "no__of_reviews", P.review_count, O.review_count)
_scalar("is_sentinel", "weight", P.is_sentinel, O.is_sentinel)


@register("split_multi", O.with_views(
    f"SELECT src_seq, uniq_id, colour AS raw, array_to_string({O.split_multi('colour')}, '|') AS value,"
    f" CAST(len({O.split_multi('colour')}) AS BIGINT) AS n_tokens FROM catalog_raw"))
def q_split_multi(spark, sf_dir):
    t = P.split_multi("colour")
    return catalog_raw(spark, sf_dir).select(
        "src_seq", "uniq_id", F.col("colour").alias("raw"), F.array_join(t, "|").alias("value"),
        F.size(t).cast("bigint").alias("n_tokens"))


@register("parse_dict", O.with_views(
    f"SELECT src_seq, uniq_id, CAST(coalesce(cardinality({O.parse_dict('sales_rank_in_parent_category')}), 0)"
    f" AS BIGINT) AS n_keys, array_to_string(map_keys({O.parse_dict('sales_rank_in_parent_category')}), '|') AS keys,"
    f" array_to_string(map_values({O.parse_dict('sales_rank_in_parent_category')}), '|') AS vals"
    f" FROM catalog_raw"))
def q_parse_dict(spark, sf_dir):
    m = P.parse_dict("sales_rank_in_parent_category")
    return catalog_raw(spark, sf_dir).select(
        "src_seq", "uniq_id", F.coalesce(F.size(m), F.lit(0)).cast("bigint").alias("n_keys"),
        F.array_join(F.map_keys(m), "|").alias("keys"),
        F.array_join(F.map_values(m), "|").alias("vals"))


@register("list_price", O.with_views(
    f"SELECT src_seq, uniq_id, round({O.list_price(O.parse_price('sales_price'), O.parse_percentage('discount_percentage'))}, 6)"
    f" AS list_price FROM catalog_raw"))
def q_list_price(spark, sf_dir):
    lp = P.list_price(P.parse_price("sales_price"), P.parse_percentage("discount_percentage"))
    return catalog_raw(spark, sf_dir).select("src_seq", "uniq_id", F.round(lp, 6).alias("list_price"))


@register("text_concat", O.with_views(
    f"SELECT src_seq, uniq_id, {O.text_concat('product_name', 'meta_keywords')} AS text FROM catalog_raw"))
def q_text_concat(spark, sf_dir):
    return catalog_raw(spark, sf_dir).select(
        "src_seq", "uniq_id", P.text_concat("product_name", "meta_keywords").alias("text"))


@register("clean_text_documents", O.with_views(
    f"SELECT doc_id, {O.clean_text('text')} AS clean FROM documents"))
def q_clean_text_documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", P.clean_text("text").alias("clean"))


_EMB = "CAST(embedding AS DOUBLE[])"


@register("cosine_pair", O.with_views(f"""
SELECT id_a, id_b, round(CASE WHEN na * nb = 0 THEN 0.0 ELSE d / (na * nb) END, 6) AS cosine
FROM (SELECT a.vec_id AS id_a, b.vec_id AS id_b, list_inner_product(a.e, b.e) AS d,
             sqrt(list_inner_product(a.e, a.e)) AS na, sqrt(list_inner_product(b.e, b.e)) AS nb
      FROM (SELECT vec_id, {_EMB} AS e FROM embeddings) a
      JOIN (SELECT vec_id, {_EMB} AS e FROM embeddings) b ON b.vec_id = a.vec_id + 1) t"""))
def q_cosine_pair(spark, sf_dir):
    """Cosine of each vector with its successor id (an equi join on vec_id + 1)."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    a, b = e.alias("a"), e.alias("b")
    return (a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1)
            .select(F.col("a.vec_id").alias("id_a"), F.col("b.vec_id").alias("id_b"),
                    F.round(V.cosine("a.embedding", "b.embedding"), 6).alias("cosine")))


@register("l2_normalise", O.with_views(f"""
SELECT vec_id, round(sqrt(list_inner_product(n, n)), 6) AS norm_after,
       round(n[1], 6) AS first_component
FROM (SELECT vec_id, CASE WHEN nrm = 0 THEN e ELSE list_transform(e, lambda x: x / nrm) END AS n
      FROM (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS nrm
            FROM (SELECT vec_id, {_EMB} AS e FROM embeddings) a) b) c"""))
def q_l2_normalise(spark, sf_dir):
    n = V.l2_normalise("embedding")
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", n.alias("n")).select(
        "vec_id", F.round(V.norm("n"), 6).alias("norm_after"),
        F.round(F.col("n")[0], 6).alias("first_component"))


@register("ngrams", O.with_views(f"""
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_grams, g[1] AS first_gram, g[-1] AS last_gram,
       CAST(coalesce(list_sum(list_transform(g, lambda x: length(x))), 0) AS BIGINT) AS gram_chars
FROM (SELECT doc_id, {O.ngrams_of('t')} AS g
      FROM (SELECT doc_id, {O.tokens(O.clean_text('text'))} AS t FROM documents) a) b"""))
def q_ngrams(spark, sf_dir):
    """Unigrams + bigrams of every whole document (cleaned, stop words out)."""
    g = F.col("g")
    return (read_table(spark, sf_dir, "documents", spread=True)
            .select("doc_id", TX.tokens(P.clean_text("text")).alias("t"))
            .select("doc_id", TX.with_bigrams("t").alias("g"))
            .select("doc_id", F.size(g).cast("bigint").alias("n_grams"),
                    F.try_element_at(g, F.lit(1)).alias("first_gram"),
                    F.try_element_at(g, F.lit(-1)).alias("last_gram"),
                    F.aggregate(g, F.lit(0).cast("bigint"),
                                lambda acc, x: acc + F.length(x)).alias("gram_chars")))


# ------------------------------------------------------------------ driver tables beyond the catalogue
@register("malformed_count", O.with_views(
    "SELECT CAST(count_if(good) AS BIGINT) AS good_lines, CAST(count_if(NOT good) AS BIGINT)"
    " AS skipped_lines FROM (SELECT coalesce(CASE WHEN json_valid(p) THEN json_type(p) = 'OBJECT' END,"
    " false) AS good FROM (SELECT CASE WHEN event_id % 37 = 0 THEN "
    "substr(props, 1, 5) WHEN event_id % 41 = 0 THEN '[1]' ELSE trim(props) END AS p FROM events) e) g"))
def q_malformed_count(spark, sf_dir):
    """Every events.props text, some of them cut short, through the record parser: parsed vs skipped."""
    from simcat.sources.ldjson import malformed_count, parse_records
    n = F.col("event_id")
    ev = read_table(spark, sf_dir, "events").select(
        F.when(n % 37 == 0, F.substring("props", 1, 5)).when(n % 41 == 0, F.lit("[1]"))
        .otherwise(F.col("props")).alias("props"))
    return malformed_count(parse_records(ev, "props", ["k"]))


@register("parse_dict_events", O.with_views(
    f"SELECT event_id, {O.category_key('props')} AS dict_key, {O.category_rank('props')} AS dict_rank"
    f" FROM events"))
def q_parse_dict_events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(
        "event_id", P.category_key("props").alias("dict_key"), P.category_rank("props").alias("dict_rank"))


@register("log1p_safe_customer", O.with_views(
    "SELECT c_custkey, round(CASE WHEN c_acctbal IS NOT NULL THEN ln(1.0::DOUBLE + greatest(c_acctbal,"
    " 0.0::DOUBLE)) END, 6) AS log_acctbal FROM customer"))
def q_log1p_safe_customer(spark, sf_dir):
    """log1p with negatives clamped to 0 (account balances go below zero)."""
    from simcat.operators.features import log1p_safe
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(log1p_safe("c_acctbal"), 6).alias("log_acctbal"))


@register("median_by_group", O.with_views(
    "SELECT event_type, CAST(count(value) AS BIGINT) AS n, round(median(value), 6) AS median_value,"
    " round(quantile_cont(value, 0.95), 6) AS p95_value FROM events WHERE value IS NOT NULL"
    " GROUP BY event_type"))
def q_median_by_group(spark, sf_dir):
    """Exact median and 95th percentile of events.value per event type (histogram passes)."""
    from simcat.operators.quantiles import quantiles
    ev = read_table(spark, sf_dir, "events").select("event_type", "value").where(F.col("value").isNotNull())
    q = quantiles(ev, "event_type", "value", [0.5, 0.95])
    wide = q.groupBy("event_type").pivot("p", [0.5, 0.95]).agg(F.first("q")).toDF("event_type", "q50", "q95")
    n = ev.groupBy("event_type").agg(F.count("value").alias("n"))
    return n.join(wide, "event_type").select("event_type", "n", F.round("q50", 6).alias("median_value"),
                                             F.round("q95", 6).alias("p95_value"))
