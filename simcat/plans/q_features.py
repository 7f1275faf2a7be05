"""Feature-block queries (raw TF-IDF text block so that SQL can check them)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from simcat.config import BLOCKS, Config
from simcat.operators import features as FT
from simcat.operators import normalise as N
from simcat.plans import oracle as O
from simcat.plans.memo import memo
from simcat.plans.registry import register
from simcat.sources import catalog_raw

CFG_RAW = Config(svd_components=0)


def products(spark, sf_dir):
    return memo(spark, ("products", sf_dir), lambda: N.normalise(catalog_raw(spark, sf_dir)))


def checkpointed_products(spark, sf_dir):
    """Cleaned products, checkpointed once per session (any config)."""
    from simcat.session import materialise
    return memo(spark, ("clean", sf_dir), lambda: materialise(products(spark, sf_dir)))


def checkpointed_counts(spark, sf_dir):
    """Their term counts with the default stop words, checkpointed once per session."""
    from simcat.session import materialise
    return memo(spark, ("counts", sf_dir),
                lambda: materialise(FT.term_counts(checkpointed_products(spark, sf_dir))))


def checkpointed_inputs(spark, sf_dir):
    return checkpointed_products(spark, sf_dir), checkpointed_counts(spark, sf_dir)


def built(spark, sf_dir, cfg=CFG_RAW, features=True):
    """Products -> fitted model -> feature table (checkpointed), once per session and config."""
    def make():
        p = checkpointed_products(spark, sf_dir)
        shared = (lambda: checkpointed_counts(spark, sf_dir)) if cfg.stop_words is None else None
        return FT.build_features(p, cfg, materialise_inputs=False, tf=shared)
    return memo(spark, ("features", sf_dir, repr(cfg)), make)


def fsql(body: str, cfg: Config = CFG_RAW) -> str:
    return O.with_views(body, *O.feature_views(cfg.weights, cfg.top_n_brands, cfg.top_n_colours,
                                               cfg.tfidf_min_df, cfg.tfidf_max_features))


@register("category_tokens", lambda: fsql(
    "SELECT product_id, array_to_string(cat_tokens, '|') AS tokens, CAST(len(cat_tokens) AS BIGINT)"
    " AS n_tokens, has_category FROM feats"))
def q_category_tokens(spark, sf_dir):
    f, _ = built(spark, sf_dir, features=False)
    return f.select("product_id", F.array_join("cat_tokens", "|").alias("tokens"),
                    F.size("cat_tokens").cast("bigint").alias("n_tokens"), "has_category")


@register("log1p_safe", lambda: fsql(
    "SELECT product_id, " + ", ".join(f"round(x{i}, 6) AS {n}" for i, (n, _) in enumerate(O.NUMERIC))
    + " FROM logged"))
def q_log1p_safe(spark, sf_dir):
    p = products(spark, sf_dir)
    return p.select("product_id", *[F.round(FT._numeric_raw(n, lg), 6).alias(n)
                                    for n, lg in FT.NUMERIC_SPECS])


@register("median_impute", lambda: fsql(
    "SELECT " + ", ".join(f"round(med{i}, 6) AS median_{n}, round(mean{i}, 6) AS mean_{n}, "
                          f"round(sc{i}, 6) AS scale_{n}" for i, (n, _) in enumerate(O.NUMERIC))
    + " FROM nstats"))
def q_median_impute(spark, sf_dir):
    p = products(spark, sf_dir)
    med, mean, sc = FT.fit_numeric(p)
    row = {}
    for n, _ in FT.NUMERIC_SPECS:
        row[f"median_{n}"], row[f"mean_{n}"], row[f"scale_{n}"] = med[n], mean[n], sc[n]
    # the statistics come from Spark jobs over the whole table; one summary row
    return spark.range(1).select(*[F.round(F.lit(v), 6).alias(k) for k, v in row.items()])


@register("missing_flags", lambda: fsql(
    "SELECT product_id, " + ", ".join(f"CAST(x{i} IS NULL AS DOUBLE) AS missing_{n}"
                                      for i, (n, _) in enumerate(O.NUMERIC)) + " FROM logged"))
def q_missing_flags(spark, sf_dir):
    p = products(spark, sf_dir)
    return p.select("product_id", *[FT._numeric_raw(n, lg).isNull().cast("double").alias(f"missing_{n}")
                                    for n, lg in FT.NUMERIC_SPECS])


@register("standard_scale", lambda: fsql(
    "SELECT product_id, " + ", ".join(f"round(v[{i + 1}], 6) AS scaled_{n}"
                                      for i, (n, _) in enumerate(O.NUMERIC)) + " FROM numraw"))
def q_standard_scale(spark, sf_dir):
    p = products(spark, sf_dir)
    med, mean, sc = FT.fit_numeric(p)
    m = FT.FeatureModel(weights={}, medians=med, means=mean, scales=sc)
    v = FT.numeric_vector(m)
    return p.select("product_id", v.alias("v")).select(
        "product_id", *[F.round(F.col("v")[i], 6).alias(f"scaled_{n}")
                        for i, (n, _) in enumerate(FT.NUMERIC_SPECS)])


@register("numeric_block", lambda: fsql(
    "SELECT product_id, has_numeric, " + ", ".join(f"round(num_vec[{i + 1}], 6) AS n{i}" for i in range(14))
    + " FROM numv"))
def q_numeric_block(spark, sf_dir):
    f, _ = built(spark, sf_dir, features=False)
    return f.select("product_id", "has_numeric",
                    *[F.round(F.col("num_vec")[i], 6).alias(f"n{i}") for i in range(14)])


@register("brand_block", lambda: fsql("SELECT product_id, brand_top, has_brand FROM feats"))
def q_brand_block(spark, sf_dir):
    f, _ = built(spark, sf_dir, features=False)
    return f.select("product_id", "brand_top", "has_brand")


@register("colour_block", lambda: fsql(
    "SELECT product_id, array_to_string(colour_top, '|') AS colour_top, has_colour FROM feats"))
def q_colour_block(spark, sf_dir):
    f, _ = built(spark, sf_dir, features=False)
    return f.select("product_id", F.array_join("colour_top", "|").alias("colour_top"), "has_colour")


@register("topn_values", lambda: fsql(
    "SELECT 'brand' AS kind, CAST(row_number() OVER (ORDER BY n DESC, brand ASC) AS BIGINT) AS rank,"
    " brand AS value, CAST(n AS BIGINT) AS n FROM brands UNION ALL "
    "SELECT 'colour', CAST(row_number() OVER (ORDER BY n DESC, token ASC) AS BIGINT), token,"
    " CAST(n AS BIGINT) FROM colours"))
def q_topn_values(spark, sf_dir):
    """Brand (top 300) and colour-token (top 60) vocabularies with their counts."""
    from pyspark.sql.window import Window
    p = products(spark, sf_dir)
    b = (p.where(F.col("brand").isNotNull() & (F.col("brand") != "")).groupBy(F.col("brand").alias("value"))
         .agg(F.count("*").alias("n")).withColumn("kind", F.lit("brand")))
    c = (p.select(F.explode("colour_tokens").alias("value")).groupBy("value")
         .agg(F.count("*").alias("n")).withColumn("kind", F.lit("colour")))
    lim = {"brand": CFG_RAW.top_n_brands, "colour": CFG_RAW.top_n_colours}
    w = Window.partitionBy("kind").orderBy(F.col("n").desc(), F.col("value").asc())
    both = b.unionByName(c).withColumn("rank", F.row_number().over(w))
    return both.where(((F.col("kind") == "brand") & (F.col("rank") <= lim["brand"]))
                      | ((F.col("kind") == "colour") & (F.col("rank") <= lim["colour"]))) \
               .select("kind", F.col("rank").cast("bigint").alias("rank"), "value", "n")


@register("effective_weights", lambda: fsql(
    "SELECT product_id, " + ", ".join(f"has_{b}, round(eff_{b}, 6) AS eff_{b}" for b in BLOCKS)
    + " FROM feats"))
def q_effective_weights(spark, sf_dir):
    f, _ = built(spark, sf_dir, features=False)
    return f.select("product_id", *[x for b in BLOCKS
                                    for x in (F.col(f"has_{b}"), F.round(f"eff_{b}", 6).alias(f"eff_{b}"))])


@register("vocabulary", lambda: fsql(
    "SELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM vocab"))
def q_vocabulary(spark, sf_dir):
    p = products(spark, sf_dir)
    tf = FT.term_counts(p)
    n = p.count()
    stats = (tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
             .where(F.col("df") >= CFG_RAW.tfidf_min_df)
             .orderBy(F.col("cf").desc(), F.col("term").asc()).limit(CFG_RAW.tfidf_max_features))
    return stats.select("term", "df", F.round(F.log((F.lit(1.0) + F.lit(n)) / (F.lit(1.0) + F.col("df")))
                                             + F.lit(1.0), 6).alias("idf"))


@register("tfidf", lambda: fsql("SELECT product_id, term, round(w, 6) AS w FROM tfidf"))
def q_tfidf(spark, sf_dir):
    p = products(spark, sf_dir)
    tf = FT.term_counts(p)
    model = FT.FeatureModel(weights={}, n_docs=p.count())
    model.vocab = FT.fit_vocabulary(tf, model.n_docs, CFG_RAW.tfidf_min_df, CFG_RAW.tfidf_max_features)
    return FT.tfidf(tf, model).select("product_id", "term", F.round("w", 6).alias("w"))


@register("unit_norm_check", lambda: fsql(
    "SELECT product_id, round(sqrt(eff_category + eff_text + eff_numeric * list_inner_product(num_vec, num_vec)"
    " + eff_brand + eff_colour), 6) AS norm FROM feats"))
def q_unit_norm_check(spark, sf_dir):
    """Norm of each product's scaled feature vector: 1 when any block is present."""
    f, _ = built(spark, sf_dir)
    return f.select("product_id", F.round(F.sqrt(F.aggregate("fvals", F.lit(0.0), lambda s, x: s + x * x)),
                                          6).alias("norm"))


def _block_stats_sql():
    cat_dims = ("(SELECT count(DISTINCT browsenode) + count(DISTINCT child_category) + "
                "count(DISTINCT parent_category) FROM products)")
    rows = [("category", cat_dims), ("text", "(SELECT count(*) FROM vocab)"), ("numeric", "14"),
            ("brand", "(SELECT count(*) FROM brands)"), ("colour", "(SELECT count(*) FROM colours)")]
    w = CFG_RAW.normalised_weights()
    return fsql(" UNION ALL ".join(
        f"SELECT '{b}' AS block, CAST({d} AS BIGINT) AS dims, round(CAST({w[b]!r} AS DOUBLE), 6) AS weight, "
        f"round(100.0::DOUBLE * avg(CAST(has_{b} AS DOUBLE)), 6) AS coverage_pct FROM feats"
        for b, d in rows))


@register("block_stats", _block_stats_sql)
def q_block_stats(spark, sf_dir):
    f, model = built(spark, sf_dir, features=False)
    p = products(spark, sf_dir)
    cat_dims = p.agg(sum(F.count_distinct(c) for c in FT.CATEGORY_COLUMNS)).first()[0]
    dims = model.block_dims()
    dims["category"] = cat_dims
    cov = f.agg(*[F.avg(F.col(f"has_{b}").cast("double")).alias(b) for b in BLOCKS])
    return cov.select(F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), F.lit(int(dims[b])).cast("bigint").alias("dims"),
                 F.round(F.lit(model.weights[b]), 6).alias("weight"),
                 F.round(F.lit(100.0) * F.col(b), 6).alias("coverage_pct")) for b in BLOCKS])).alias("s")) \
        .select("s.*")
