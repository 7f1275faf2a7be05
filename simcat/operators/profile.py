"""Data-quality reports over a raw catalogue table; each report is a DataFrame.

Wide reports are one aggregation pass (partial aggregates per partition, one
row out) that is then turned long with ``stack``.  Frequency reports build a
``(column, value) -> n`` table once; top-k reads use ``row_number() <= k``,
which Catalyst executes as a partial group limit before the shuffle, so a
column with millions of distinct values never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simcat.functions import parsers as P
from simcat.functions import text as TX
from simcat.operators.quantiles import quantiles

# Fixed values: "blank" text in the two profiling passes (compared after strip).
BLANK_TOKENS_V1 = ["", "nan", "None"]
BLANK_TOKENS_V2 = ["", "nan", "None", "<NA>"]


def blank_v1(c) -> F.Column:
    """Null (printed as 'None') or stripped text in ('', 'nan', 'None')."""
    return P.strip(F.coalesce(F.col(c).cast("string"), F.lit("None"))).isin(*BLANK_TOKENS_V1)


def blank_v2(c) -> F.Column:
    return F.col(c).isNull() | P.strip(F.col(c).cast("string")).isin(*BLANK_TOKENS_V2)


def _stack(one_row: DataFrame, items: list[tuple], names: list[str], keep=()) -> DataFrame:
    """Turn a one-row wide result into one row per item (``keep`` columns ride along).

    An item is (label, [column, ...]) or (label, literal, [column, ...]).
    """
    parts = []
    for item in items:
        label, cols = item[0], item[-1]
        parts.append(f"'{label}'")
        parts.extend(f"'{lit}'" for lit in item[1:-1])
        parts.extend(f"`{c}`" for c in cols)
    expr = f"stack({len(items)}, {', '.join(parts)}) as ({', '.join(names)})"
    return one_row.select(F.expr(expr), *keep)


def null_report(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: type, non-null count, null % and blank-or-null % (1 dp), rows, columns."""
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.col(c)).alias(f"nn{i}"), F.count_if(blank_v1(c)).alias(f"bl{i}")]
    wide = raw.agg(*aggs)
    long = _stack(wide, [(c, raw.schema[c].dataType.simpleString(), [f"nn{i}", f"bl{i}"])
                         for i, c in enumerate(columns)],
                  ["field", "dtype", "non_null", "blank"], keep=[F.col("_n").alias("n_rows")])
    pct = lambda x: F.bround(F.lit(100.0) * x / F.col("n_rows"), 1)
    return (long
            .select("field", "dtype", F.col("non_null").cast("bigint").alias("non_null"),
                    pct(F.col("n_rows") - F.col("non_null")).alias("null_pct"),
                    pct(F.col("blank")).alias("blank_or_null_pct"),
                    F.col("n_rows").cast("bigint").alias("n_rows"),
                    F.lit(len(columns)).cast("bigint").alias("n_columns"))
            .orderBy("blank_or_null_pct", "field"))                 # one row per column


def first_values(raw: DataFrame, columns: list[str], n: int, blank) -> DataFrame:
    """First ``n`` non-blank values per column in ``src_seq`` order: (column, pos, value)."""
    long = raw.select("src_seq", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"),
                 blank(c).alias("is_blank")) for c in columns])).alias("s"))
    long = long.select("src_seq", "s.*").where(~F.col("is_blank"))
    w = Window.partitionBy("field").orderBy("src_seq")
    return (long.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
            .select("field", F.col("pos").cast("bigint").alias("pos"), "value"))


def parse_quality(raw: DataFrame, checks: list[tuple[str, str]], sentinel: float = 1e6) -> DataFrame:
    """Per (role, column): % parsed, min / median / max of parsed values, 4 raw samples.

    ``checks`` pairs a role (price, sale, weight, rating) with a raw column; the
    profiler's lenient parsers are used.
    """
    fns = {"price": lambda c: P.parse_price(c, lenient=True),
           "sale": lambda c: P.parse_price(c, lenient=True),
           "weight": lambda c: P.parse_weight(c, sentinel, lenient=True),
           "rating": lambda c: P.parse_rating(c, lenient=True)}
    parsed = raw.select(F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(col).alias("field"),
                 fns[role](col).alias("v")) for role, col in checks])).alias("s")).select("s.*")
    summary = parsed.groupBy("role", "field").agg(
        F.round(F.lit(100.0) * F.avg(F.col("v").isNotNull().cast("double")), 6).alias("pct_parsed"),
        F.round(F.min("v"), 6).alias("min_parsed"),
        F.round(F.max("v"), 6).alias("max_parsed"))
    med = quantiles(parsed.select(F.concat_ws("\u0001", "role", "field").alias("rc"), "v")
                    .where(F.col("v").isNotNull()), "rc", "v", [0.5])
    med = med.select(F.split("rc", "\u0001").getItem(0).alias("role"),
                     F.split("rc", "\u0001").getItem(1).alias("field"),
                     F.round("q", 6).alias("median_parsed"))
    cols = sorted({c for _, c in checks})
    samples = (first_values(raw, cols, 4, lambda c: F.col(c).isNull() | (P.strip(F.col(c)) == ""))
               .groupBy("field")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))),
                                             lambda s: s["value"]), " | ").alias("raw_samples")))
    return (summary.join(med, ["role", "field"], "left").join(samples, "field", "left")
            .select("role", "field", "pct_parsed", "min_parsed", "median_parsed", "max_parsed",
                    "raw_samples"))


def frequencies(raw: DataFrame, columns: list[str], value_of, keep) -> DataFrame:
    """(column, value, n) frequency table of cleaned values."""
    long = raw.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), value_of(c).alias("value"), keep(c).alias("keep"))
        for c in columns])).alias("s")).select("s.*").where(F.col("keep"))
    return long.groupBy("field", "value").agg(F.count("*").alias("n"))


def _ranked(freq: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value").asc())
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def value_topn(raw: DataFrame, columns: list[str], top: int = 10, cover: int = 100) -> DataFrame:
    """Cardinality report: distinct values, rows, top-``cover`` coverage %, top ``top`` values.

    Values are stripped and lower-cased; null and empty values are left out.
    (The distinct count is the number of distinct values, not of distinct
    frequencies.)
    """
    s = lambda c: F.lower(P.strip(F.col(c)))
    freq = frequencies(raw, columns, s, lambda c: F.col(c).isNotNull() & (s(c) != ""))
    summary = freq.groupBy("field").agg(F.count("*").alias("n_distinct"),
                                         F.sum("n").alias("n_rows"))
    cov = (_ranked(freq, cover).groupBy("field").agg(F.sum("n").alias("top_n")))
    top_rows = _ranked(freq, top)
    return (top_rows.join(summary, "field").join(cov, "field")
            .select("field", F.col("rank").cast("bigint").alias("rank"), "value", "n",
                    "n_distinct", F.col("n_rows").cast("bigint").alias("n_rows"),
                    F.round(F.lit(100.0) * F.col("top_n") / F.col("n_rows"), 6)
                    .alias("top_coverage_pct")))


def topk_coverage(raw: DataFrame, columns: list[str], ks=(20, 50, 100, 200, 500)) -> DataFrame:
    """True cardinality: distinct, coverage, top-k coverage (k <= distinct), singletons."""
    s = lambda c: F.lower(P.strip(F.col(c).cast("string")))
    freq = frequencies(raw, columns, s, lambda c: ~blank_v2(c))
    n_total = raw.select(F.count("*")).scalar()      # scalar subquery
    summary = freq.groupBy("field").agg(
        F.count("*").alias("n_distinct"), F.sum("n").alias("n_nonblank"),
        F.count_if(F.col("n") == 1).alias("singletons"))
    top = _ranked(freq, max(ks)).groupBy("field").agg(
        *[F.sum(F.when(F.col("rank") <= k, F.col("n"))).alias(f"top{k}") for k in ks])
    out = summary.join(top, "field").withColumn("n_total", n_total)
    pct = lambda x, d: F.round(F.lit(100.0) * x / d, 6)
    return out.select(
        "field", "n_distinct", F.col("n_nonblank").cast("bigint").alias("n_nonblank"),
        pct(F.col("n_nonblank"), F.col("n_total")).alias("coverage_pct"),
        *[F.when(F.col("n_distinct") >= k, pct(F.col(f"top{k}"), F.col("n_nonblank")))
          .alias(f"top{k}_pct") for k in ks],
        F.col("singletons").cast("bigint").alias("singletons"),
        pct(F.col("singletons"), F.col("n_distinct")).alias("singleton_pct"))


def token_stats(raw: DataFrame, column: str, sep: str = "|", top: int = 25) -> DataFrame:
    """Delimited multi-value column: rows, distinct raw strings, distinct tokens,
    tokens per row (median, max), and the ``top`` most frequent tokens."""
    s = raw.where(~blank_v2(column)).select(F.lower(F.col(column)).alias("s"))
    parts = s.select("s", F.filter(F.transform(F.split("s", "\\" + sep), lambda p: P.strip(p)),
                                   lambda p: p != "").alias("t"))
    per_row = parts.select(F.lit("x").alias("k"), F.size("t").cast("double").alias("n_tok"))
    med = quantiles(per_row, "k", "n_tok", [0.5]).select(F.col("q").alias("median_tokens"))
    summary = parts.agg(F.count("*").alias("n_rows"), F.count_distinct("s").alias("n_distinct_raw"),
                        F.max(F.size("t")).cast("bigint").alias("max_tokens"))
    tok = parts.select(F.explode("t").alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    n_tok = tok.agg(F.count("*").alias("n_distinct_tokens"))
    w = Window.orderBy(F.col("n").desc(), F.col("value").asc())
    top_rows = (tok.withColumn("field", F.lit(column)).withColumn(
        "rank", F.row_number().over(w.partitionBy("field"))).where(F.col("rank") <= top))
    return top_rows.select(
        F.col("rank").cast("bigint").alias("rank"), F.col("value").alias("token"), "n",
        summary.select("n_rows").scalar().alias("n_rows"),
        summary.select("n_distinct_raw").scalar().alias("n_distinct_raw"),
        n_tok.select("n_distinct_tokens").scalar().alias("n_distinct_tokens"),
        F.round(med.select("median_tokens").scalar(), 6).alias("median_tokens"),
        summary.select("max_tokens").scalar().alias("max_tokens"))


def sentinel_report(raw: DataFrame, column: str = "weight") -> DataFrame:
    return raw.agg(
        F.count("*").alias("total"),
        F.count_if(P.is_sentinel(F.coalesce(F.col(column), F.lit("None")))).alias("sentinels"),
        F.count_if(blank_v2(column)).alias("blank")).select(
        "total", "sentinels", F.round(F.lit(100.0) * F.col("sentinels") / F.col("total"), 6)
        .alias("sentinel_pct"), "blank")


UNIT_PATTERN = r"[\d.,]+\s*([a-z]+)"


def unit_histogram(raw: DataFrame, column: str = "weight", top: int = 12) -> DataFrame:
    """First unit word after a number, else '(no unit)'; the ``top`` most common."""
    s = F.lower(P.strip(F.coalesce(F.col(column), F.lit("None"))))
    unit = F.when(s.rlike(UNIT_PATTERN), F.regexp_extract(s, UNIT_PATTERN, 1)) \
            .otherwise(F.lit("(no unit)"))
    freq = raw.select(F.lit(column).alias("field"), unit.alias("value")) \
              .groupBy("field", "value").agg(F.count("*").alias("n"))
    return _ranked(freq, top).select(F.col("rank").cast("bigint").alias("rank"),
                                      F.col("value").alias("unit"), "n")


def non_sentinel_sample(raw: DataFrame, column: str = "weight", n: int = 20) -> DataFrame:
    """First ``n`` values (stripped, lower) that are not the sentinel, in file order."""
    s = F.lower(P.strip(F.coalesce(F.col(column), F.lit("None"))))
    return (raw.select("src_seq", s.alias("value")).where(~P.is_sentinel(F.col("value")))
            .orderBy("src_seq").limit(n))


def rating_describe(raw: DataFrame, column: str = "rating") -> DataFrame:
    """count, mean, std (sample), min, quartiles, max of the leniently numeric rating."""
    r = raw.select(F.lit("x").alias("k"), P.to_number(column).alias("r"))
    stats = r.agg(F.count("r").alias("count"), F.round(F.avg("r"), 6).alias("mean"),
                  F.round(F.stddev_samp("r"), 6).alias("std"), F.min("r").alias("min"),
                  F.max("r").alias("max"))
    qs = quantiles(r.where(F.col("r").isNotNull()), "k", "r", [0.25, 0.5, 0.75])
    qv = {n: F.round(qs.where(F.col("p") == p).select("q").scalar(), 6).alias(n)
          for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    return stats.select("count", "mean", "std", "min", qv["p25"], qv["p50"], qv["p75"], "max")


def rating_counts(raw: DataFrame, column: str = "rating", top: int = 12) -> DataFrame:
    r = raw.select(F.lit(column).alias("field"), P.to_number(column).alias("value")) \
           .where(F.col("value").isNotNull())
    freq = r.groupBy("field", "value").agg(F.count("*").alias("n"))
    return _ranked(freq, top).select(F.col("rank").cast("bigint").alias("rank"), "value", "n")


def rating_trust(raw: DataFrame, rating: str = "rating", reviews: str = "no__of_reviews") -> DataFrame:
    """Rows with a usable review count, review median / max, mean rating with vs without."""
    d = raw.select(P.to_number(rating).alias("r"), P.review_count(reviews).alias("nr"))
    has = F.col("nr").isNotNull() & (F.col("nr") > 0)
    d = d.withColumn("has", has)
    agg = d.agg(F.count("*").alias("n"), F.count_if("has").alias("with_reviews"),
                F.max(F.when(F.col("has"), F.col("nr"))).alias("max_reviews"),
                F.round(F.avg(F.when(F.col("has"), F.col("r"))), 6).alias("mean_rating_known"),
                F.round(F.avg(F.when(~F.col("has"), F.col("r"))), 6).alias("mean_rating_unknown"))
    med = quantiles(d.where("has").select(F.lit("x").alias("k"), "nr"), "k", "nr", [0.5])
    return agg.withColumn("median_reviews", F.round(med.select("q").scalar(), 6)).select(
        "with_reviews", F.round(F.lit(100.0) * F.col("with_reviews") / F.col("n"), 6)
        .alias("with_reviews_pct"), "median_reviews", "max_reviews", "mean_rating_known",
        "mean_rating_unknown")


def text_lengths(raw: DataFrame, columns: list[str], blank=None, sample_chars: int = 150) -> DataFrame:
    """Per text column: non-blank rows, median and p95 word counts (int-truncated), a sample."""
    blank = blank or blank_v2
    long = raw.select("src_seq", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"),
                 blank(c).alias("is_blank")) for c in columns])).alias("s")) \
        .select("src_seq", "s.*").where(~F.col("is_blank"))
    # one pass over the whole texts; the later passes read this narrow table
    from simcat.session import materialise
    long = materialise(long.select("field", "src_seq", TX.word_count("value").cast("double").alias("words"),
                                   F.substring("value", 1, sample_chars).alias("value")))
    summary = long.groupBy("field").agg(
        F.count("*").alias("non_blank"), F.min_by("value", "src_seq").alias("sample"))
    qs = quantiles(long, "field", "words", [0.5, 0.95])
    qw = qs.groupBy("field").pivot("p", [0.5, 0.95]).agg(F.first("q")).toDF("field", "q50", "q95")
    qw = qw.select("field", F.floor(F.col("q50") + F.lit(1e-9)).cast("bigint").alias("median_words"),
                   F.floor(F.col("q95") + F.lit(1e-9)).cast("bigint").alias("p95_words"))
    return summary.join(qw, "field").select("field", "non_blank", "median_words", "p95_words",
                                             "sample")


def category_report(raw: DataFrame, column: str, top: int = 15, cut: int = 100) -> DataFrame:
    """Coverage, distinct count and the ``top`` most common values (cut to ``cut`` chars)."""
    keep = ~blank_v2(column)
    n_total = raw.select(F.count("*")).scalar()      # scalar subqueries, merged by Catalyst
    freq = raw.where(keep).select(F.col(column).cast("string").alias("value")) \
              .groupBy("value").agg(F.count("*").alias("n"))
    covered = freq.select(F.sum("n")).scalar()
    n_distinct = freq.select(F.count("*")).scalar()
    ranked = _ranked(freq.withColumn("field", F.lit(column)), top)
    return ranked.select(
        "field", F.col("rank").cast("bigint").alias("rank"),
        F.substring("value", 1, cut).alias("value"), "n",
        covered.cast("bigint").alias("covered"),
        F.round(F.lit(100.0) * covered / n_total, 6).alias("coverage_pct"),
        n_distinct.alias("n_distinct"))


def url_coverage(raw: DataFrame, columns: list[str], cut: int = 130) -> DataFrame:
    """Per URL column present: non-blank rows and %, and the first non-blank value."""
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(~blank_v2(c)).alias(f"n{i}"),
                 F.substring(F.min_by(F.when(~blank_v2(c), F.col(c)),
                                      F.when(~blank_v2(c), F.col("src_seq"))), 1, cut)
                 .alias(f"s{i}")]
    wide = raw.agg(*aggs)
    long = _stack(wide, [(c, [f"n{i}", f"s{i}"]) for i, c in enumerate(columns)],
                  ["field", "rows", "sample"], keep=["_n"])
    return long.select(
        "field", F.col("rows").cast("bigint").alias("rows"),
        F.round(F.lit(100.0) * F.col("rows") / F.col("_n"), 6).alias("pct"), "sample")


def id_integrity(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Per id column: rows, distinct non-null ids, unique?, null count."""
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        aggs += [F.count_distinct(c).alias(f"d{i}"), F.count_if(F.col(c).isNull()).alias(f"z{i}")]
    wide = raw.agg(*aggs)
    long = _stack(wide, [(c, [f"d{i}", f"z{i}"]) for i, c in enumerate(columns)],
                  ["field", "n_distinct", "n_null"], keep=[F.col("_n").alias("n_rows")])
    return long.select(
        "field", "n_rows", F.col("n_distinct").cast("bigint").alias("n_distinct"),
        (F.col("n_distinct") == F.col("n_rows")).alias("is_unique"),
        F.col("n_null").cast("bigint").alias("n_null"))


def preview_long(raw: DataFrame, columns: list[str], n: int = 2, cut: int = 110) -> DataFrame:
    """First ``n`` records as (record, column, value); long values cut with a marker."""
    first = raw.orderBy("src_seq").limit(n)
    w = Window.orderBy("src_seq")
    first = first.withColumn("record", (F.row_number().over(w) - 1).cast("bigint"))
    long = first.select("record", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"),
                 F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("v"))
        for c in columns])).alias("s")).select("record", "s.*")
    return long.select("record", "field",
                       F.when(F.length("v") > cut, F.concat(F.substring("v", 1, cut),
                                                            F.lit(" ...[truncated]")))
                       .otherwise(F.col("v")).alias("value"))
