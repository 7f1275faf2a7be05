"""Profiling reports on the raw catalogue (and text lengths on documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simcat.operators import profile as PR
from simcat.plans import oracle as O
from simcat.plans.registry import register
from simcat.sources import RAW_COLUMNS, catalog_raw, read_table

DUMP_COLUMNS = [c for c in RAW_COLUMNS if c != "src_seq"]


def _blank_v1(c):
    text = f"coalesce(CAST({c} AS VARCHAR), 'None')"
    return f"({O.strip(text)} IN ('', 'nan', 'None'))"


def _blank_v2(c):
    return f"({c} IS NULL OR {O.strip(f'CAST({c} AS VARCHAR)')} IN ('', 'nan', 'None', '<NA>'))"


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ null report
def _null_sql():
    parts = [f"""SELECT '{c}' AS field, 'string' AS dtype, CAST(count({c}) AS BIGINT) AS non_null,
  round_even(100.0::DOUBLE * (count(*) - count({c})) / count(*), 1) AS null_pct,
  round_even(100.0::DOUBLE * count_if({_blank_v1(c)}) / count(*), 1) AS blank_or_null_pct,
  CAST(count(*) AS BIGINT) AS n_rows, CAST({len(DUMP_COLUMNS)} AS BIGINT) AS n_columns
FROM catalog_raw""" for c in DUMP_COLUMNS]
    return O.with_views(_union(parts))


@register("null_report", _null_sql)
def q_null_report(spark, sf_dir):
    return PR.null_report(catalog_raw(spark, sf_dir), DUMP_COLUMNS)


# ------------------------------------------------------------------ parse quality
PQ_CHECKS = [("sale", "sales_price"), ("weight", "weight"), ("rating", "rating")]


def _pq_sql():
    fns = {"sale": lambda c: O.parse_price(c, lenient=True),
           "weight": lambda c: O.parse_weight(c, lenient=True),
           "rating": lambda c: O.parse_rating(c, lenient=True)}
    parts = []
    for role, c in PQ_CHECKS:
        parts.append(f"""SELECT '{role}' AS role, '{c}' AS field,
  round(100.0::DOUBLE * count(v) / count(*), 6) AS pct_parsed,
  round(min(v), 6) AS min_parsed, round(median(v), 6) AS median_parsed,
  round(max(v), 6) AS max_parsed,
  (SELECT string_agg({c}, ' | ' ORDER BY src_seq) FROM (SELECT {c}, src_seq FROM catalog_raw
     WHERE {c} IS NOT NULL AND {O.strip(c)} <> '' ORDER BY src_seq LIMIT 4) s) AS raw_samples
FROM (SELECT {fns[role](c)} AS v FROM catalog_raw) t""")
    return O.with_views(_union(parts))


@register("parse_quality", _pq_sql)
def q_parse_quality(spark, sf_dir):
    return PR.parse_quality(catalog_raw(spark, sf_dir), PQ_CHECKS)


# ------------------------------------------------------------------ cardinality
CARD_COLUMNS = ["brand", "colour"]


def _ranked_sql(freq_sql, k):
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value ASC)
  AS rank FROM ({freq_sql}) f) r WHERE rank <= {k}"""


def _value_topn_sql():
    freq = _union([f"""SELECT '{c}' AS field, lower({O.strip(c)}) AS value, count(*) AS n FROM catalog_raw
  WHERE {c} IS NOT NULL AND lower({O.strip(c)}) <> '' GROUP BY 1, 2""" for c in CARD_COLUMNS])
    return O.with_views(f"""SELECT t.field, CAST(t.rank AS BIGINT) AS rank, t.value, CAST(t.n AS BIGINT) AS n,
  CAST(s.n_distinct AS BIGINT) AS n_distinct, CAST(s.n_rows AS BIGINT) AS n_rows,
  round(100.0::DOUBLE * c.top_n / s.n_rows, 6) AS top_coverage_pct
FROM ({_ranked_sql('SELECT * FROM freq', 10)}) t
JOIN (SELECT field, count(*) AS n_distinct, sum(n) AS n_rows FROM freq GROUP BY field) s USING (field)
JOIN (SELECT field, sum(n) AS top_n FROM ({_ranked_sql('SELECT * FROM freq', 100)}) x GROUP BY field) c
  USING (field)""", ("freq", freq))


@register("value_topn", _value_topn_sql)
def q_value_topn(spark, sf_dir):
    return PR.value_topn(catalog_raw(spark, sf_dir), CARD_COLUMNS)


KS = (20, 50, 100, 200, 500)


def _topk_cov_sql():
    freq = _union([f"""SELECT '{c}' AS field, lower({O.strip(f'CAST({c} AS VARCHAR)')}) AS value,
  count(*) AS n FROM catalog_raw WHERE NOT {_blank_v2(c)} GROUP BY 1, 2""" for c in CARD_COLUMNS])
    tops = ", ".join(f"sum(CASE WHEN rank <= {k} THEN n END) AS top{k}" for k in KS)
    pcts = ", ".join(f"CASE WHEN s.n_distinct >= {k} THEN round(100.0::DOUBLE * t.top{k} / s.n_nonblank, 6) END"
                     f" AS top{k}_pct" for k in KS)
    return O.with_views(f"""SELECT s.field, CAST(s.n_distinct AS BIGINT) AS n_distinct,
  CAST(s.n_nonblank AS BIGINT) AS n_nonblank,
  round(100.0::DOUBLE * s.n_nonblank / (SELECT count(*) FROM catalog_raw), 6) AS coverage_pct, {pcts},
  CAST(s.singletons AS BIGINT) AS singletons,
  round(100.0::DOUBLE * s.singletons / s.n_distinct, 6) AS singleton_pct
FROM (SELECT field, count(*) AS n_distinct, sum(n) AS n_nonblank, count_if(n = 1) AS singletons
      FROM freq GROUP BY field) s
JOIN (SELECT field, {tops} FROM ({_ranked_sql('SELECT * FROM freq', max(KS))}) r GROUP BY field) t
  USING (field)""", ("freq", freq))


@register("topk_coverage", _topk_cov_sql)
def q_topk_coverage(spark, sf_dir):
    return PR.topk_coverage(catalog_raw(spark, sf_dir), CARD_COLUMNS)


# ------------------------------------------------------------------ colour tokens
def _token_stats_sql():
    parts = (f"list_filter(list_transform(string_split(s, '|'), lambda p: {O.strip('p')}), "
             f"lambda p: p <> '')")
    return O.with_views(f"""SELECT CAST(r.rank AS BIGINT) AS rank, r.value AS token, CAST(r.n AS BIGINT) AS n,
  CAST(m.n_rows AS BIGINT) AS n_rows, CAST(m.n_distinct_raw AS BIGINT) AS n_distinct_raw,
  CAST(m.n_distinct_tokens AS BIGINT) AS n_distinct_tokens, round(m.median_tokens, 6) AS median_tokens,
  CAST(m.max_tokens AS BIGINT) AS max_tokens
FROM ({_ranked_sql("SELECT 'colour' AS field, value, count(*) AS n FROM (SELECT unnest(t) AS value FROM parts) u GROUP BY value", 25)}) r,
 (SELECT count(*) AS n_rows, count(DISTINCT s) AS n_distinct_raw, median(len(t)) AS median_tokens,
         max(len(t)) AS max_tokens,
         (SELECT count(DISTINCT value) FROM (SELECT unnest(t) AS value FROM parts) u) AS n_distinct_tokens
  FROM parts) m""", ("parts", f"SELECT s, {parts} AS t FROM (SELECT lower(colour) AS s FROM catalog_raw "
                              f"WHERE NOT {_blank_v2('colour')}) x"))


@register("token_stats", _token_stats_sql)
def q_token_stats(spark, sf_dir):
    return PR.token_stats(catalog_raw(spark, sf_dir), "colour")


# ------------------------------------------------------------------ weight
def _wstr():
    text = "coalesce(weight, 'None')"
    return f"lower({O.strip(text)})"


@register("sentinel_report", lambda: O.with_views(f"""SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count_if({O.is_sentinel(f"coalesce(weight, 'None')")}) AS BIGINT) AS sentinels,
  round(100.0::DOUBLE * count_if({O.is_sentinel(f"coalesce(weight, 'None')")}) / count(*), 6) AS sentinel_pct,
  CAST(count_if({_blank_v2('weight')}) AS BIGINT) AS blank FROM catalog_raw"""))
def q_sentinel_report(spark, sf_dir):
    return PR.sentinel_report(catalog_raw(spark, sf_dir))


@register("unit_histogram", lambda: O.with_views(f"""SELECT CAST(rank AS BIGINT) AS rank, value AS unit,
  CAST(n AS BIGINT) AS n FROM ({_ranked_sql(f'''SELECT 'weight' AS field, CASE WHEN regexp_matches({_wstr()},
  {O.q(PR.UNIT_PATTERN)}) THEN regexp_extract({_wstr()}, {O.q(PR.UNIT_PATTERN)}, 1) ELSE '(no unit)' END AS value,
  count(*) AS n FROM catalog_raw GROUP BY 1, 2''', 12)}) r"""))
def q_unit_histogram(spark, sf_dir):
    return PR.unit_histogram(catalog_raw(spark, sf_dir))


@register("non_sentinel_sample", lambda: O.with_views(f"""SELECT src_seq, value FROM (SELECT src_seq,
  {_wstr()} AS value FROM catalog_raw) t WHERE NOT {O.is_sentinel('value')} ORDER BY src_seq LIMIT 20"""))
def q_non_sentinel_sample(spark, sf_dir):
    return PR.non_sentinel_sample(catalog_raw(spark, sf_dir))


# ------------------------------------------------------------------ rating
@register("rating_describe", lambda: O.with_views(f"""SELECT CAST(count(r) AS BIGINT) AS count,
  round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std, min(r) AS min,
  round(quantile_cont(r, 0.25), 6) AS p25, round(quantile_cont(r, 0.5), 6) AS p50,
  round(quantile_cont(r, 0.75), 6) AS p75, max(r) AS max
FROM (SELECT {O.to_number('rating')} AS r FROM catalog_raw) t"""))
def q_rating_describe(spark, sf_dir):
    return PR.rating_describe(catalog_raw(spark, sf_dir))


@register("rating_counts", lambda: O.with_views(f"""SELECT CAST(rank AS BIGINT) AS rank, value, CAST(n AS BIGINT) AS n
FROM ({_ranked_sql(f"SELECT 'rating' AS field, {O.to_number('rating')} AS value, count(*) AS n FROM catalog_raw WHERE {O.to_number('rating')} IS NOT NULL GROUP BY 1, 2", 12)}) r"""))
def q_rating_counts(spark, sf_dir):
    return PR.rating_counts(catalog_raw(spark, sf_dir))


@register("rating_trust", lambda: O.with_views(f"""SELECT CAST(count_if(has) AS BIGINT) AS with_reviews,
  round(100.0::DOUBLE * count_if(has) / count(*), 6) AS with_reviews_pct,
  round(median(CASE WHEN has THEN nr END), 6) AS median_reviews,
  max(CASE WHEN has THEN nr END) AS max_reviews,
  round(avg(CASE WHEN has THEN r END), 6) AS mean_rating_known,
  round(avg(CASE WHEN NOT has THEN r END), 6) AS mean_rating_unknown
FROM (SELECT r, nr, coalesce(nr IS NOT NULL AND nr > 0, false) AS has FROM
  (SELECT {O.to_number('rating')} AS r, {O.review_count('no__of_reviews')} AS nr FROM catalog_raw) a) t"""))
def q_rating_trust(spark, sf_dir):
    return PR.rating_trust(catalog_raw(spark, sf_dir))


# ------------------------------------------------------------------ text lengths
TEXT_COLUMNS = ["product_name", "meta_keywords", "browsenode", "parent___child_category__all",
                "product_details__k_v_pairs"]


def _text_len_sql(table, cols, key="src_seq"):
    parts = _union([f"SELECT '{c}' AS field, {key} AS seq, CAST({c} AS VARCHAR) AS value FROM {table} "
                    f"WHERE NOT {_blank_v2(c)}" for c in cols])
    return f"""SELECT field, CAST(count(*) AS BIGINT) AS non_blank,
  CAST(floor(quantile_cont(w, 0.5) + 1e-9) AS BIGINT) AS median_words,
  CAST(floor(quantile_cont(w, 0.95) + 1e-9) AS BIGINT) AS p95_words,
  substr(arg_min(value, seq), 1, 150) AS sample
FROM (SELECT field, seq, value, CAST({O.word_count('value')} AS DOUBLE) AS w FROM ({parts}) p) t
GROUP BY field"""


@register("text_lengths", lambda: O.with_views(_text_len_sql("catalog_raw", TEXT_COLUMNS)))
def q_text_lengths(spark, sf_dir):
    return PR.text_lengths(catalog_raw(spark, sf_dir), TEXT_COLUMNS)


@register("text_lengths_documents", lambda: O.with_views(_text_len_sql("documents", ["text"], "doc_id")))
def q_text_lengths_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", spread=True).select(F.col("doc_id").alias("src_seq"), "text")
    return PR.text_lengths(docs, ["text"])


# ------------------------------------------------------------------ categories, urls, ids
def _cat_report_sql(c="sales_rank_in_child_category"):
    return O.with_views(f"""SELECT r.field, CAST(r.rank AS BIGINT) AS rank, substr(r.value, 1, 100) AS value,
  CAST(r.n AS BIGINT) AS n, CAST(s.covered AS BIGINT) AS covered,
  round(100.0::DOUBLE * s.covered / (SELECT count(*) FROM catalog_raw), 6) AS coverage_pct,
  CAST(s.n_distinct AS BIGINT) AS n_distinct
FROM ({_ranked_sql('SELECT * FROM freq', 15)}) r
JOIN (SELECT field, count(*) AS n_distinct, sum(n) AS covered FROM freq GROUP BY field) s USING (field)""",
                        ("freq", f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS n "
                                 f"FROM catalog_raw WHERE NOT {_blank_v2(c)} GROUP BY 1, 2"))


@register("category_report", _cat_report_sql)
def q_category_report(spark, sf_dir):
    return PR.category_report(catalog_raw(spark, sf_dir), "sales_rank_in_child_category")


@register("category_report_all", lambda: _cat_report_sql("parent___child_category__all"))
def q_category_report_all(spark, sf_dir):
    return PR.category_report(catalog_raw(spark, sf_dir), "parent___child_category__all")


URL_COLUMNS = ["image_urls__small", "medium", "large"]


@register("url_coverage", lambda: O.with_views(_union([f"""SELECT '{c}' AS field,
  CAST(count_if(NOT {_blank_v2(c)}) AS BIGINT) AS rows,
  round(100.0::DOUBLE * count_if(NOT {_blank_v2(c)}) / count(*), 6) AS pct,
  substr(arg_min(CASE WHEN NOT {_blank_v2(c)} THEN {c} END, CASE WHEN NOT {_blank_v2(c)} THEN src_seq END), 1, 130)
    AS sample FROM catalog_raw""" for c in URL_COLUMNS])))
def q_url_coverage(spark, sf_dir):
    return PR.url_coverage(catalog_raw(spark, sf_dir), URL_COLUMNS)


@register("url_coverage_pages", lambda: O.with_views("""SELECT 'url' AS field,
  CAST(count_if(NOT (url IS NULL OR regexp_replace(url, '^\\s+|\\s+$', '', 'g') IN ('', 'nan', 'None', '<NA>'))) AS BIGINT) AS rows,
  round(100.0::DOUBLE * count_if(NOT (url IS NULL OR regexp_replace(url, '^\\s+|\\s+$', '', 'g') IN ('', 'nan', 'None', '<NA>'))) / count(*), 6) AS pct,
  substr(arg_min(url, page_id), 1, 130) AS sample FROM pages"""))
def q_url_coverage_pages(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("src_seq"), "url")
    return PR.url_coverage(pages, ["url"])


ID_COLUMNS = ["uniq_id", "asin"]


@register("id_integrity", lambda: O.with_views(_union([f"""SELECT '{c}' AS field, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, count(DISTINCT {c}) = count(*) AS is_unique,
  CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM catalog_raw""" for c in ID_COLUMNS])))
def q_id_integrity(spark, sf_dir):
    return PR.id_integrity(catalog_raw(spark, sf_dir), ID_COLUMNS)


@register("preview_long", lambda: O.with_views(_union([f"""SELECT record, '{c}' AS field,
  CASE WHEN length(v) > 110 THEN substr(v, 1, 110) || ' ...[truncated]' ELSE v END AS value
FROM (SELECT CAST(row_number() OVER (ORDER BY src_seq) - 1 AS BIGINT) AS record,
             coalesce(CAST({c} AS VARCHAR), 'None') AS v
      FROM (SELECT * FROM catalog_raw ORDER BY src_seq LIMIT 2) f) t""" for c in DUMP_COLUMNS])))
def q_preview_long(spark, sf_dir):
    return PR.preview_long(catalog_raw(spark, sf_dir), DUMP_COLUMNS)
