"""Feature blocks: fit bounded statistics on the product table, then transform.

Five blocks as in the original model: category, text, numeric, brand, colour.
Each block is unit-normalised per row; a block missing for a row hands its
weight to the row's present blocks.  The score of two products is

    score(a, b) = sum_i sqrt(eff_i(a) * eff_i(b)) * cos_i(a, b)

which equals the dot product of the concatenated, sqrt(eff)-scaled unit blocks.
Rather than materialising that dense vector, every product carries a sparse
feature list ``(fkeys, fvals)`` whose values already include the scaling, so
search is a sparse dot product (see ``simcat.operators.search``).

``fit`` only collects bounded things: six medians (exact, by the distributed
quantile operator), six means and deviations, at most ``top_n_brands`` brands,
``top_n_colours`` colours and ``tfidf_max_features`` terms.  ``transform`` is a
projection plus one broadcast join against the (bounded) vocabulary and an
aggregation keyed by product id.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simcat.config import BLOCKS, Config
from simcat.functions import text as TX
from simcat.operators.quantiles import quantiles

# Numeric columns in block order, and whether each is log-scaled.
NUMERIC_SPECS = [
    ("sales_price", True),
    ("list_price", True),
    ("rating", False),
    ("discount_percentage", False),
    ("weight_grams", True),
    ("sales_rank", True),
]
FLAG_COLUMNS = ["is_prime", "is_best_seller"]
CATEGORY_COLUMNS = ["browsenode", "child_category", "parent_category"]
DISPLAY_COLUMNS = ["product_name", "brand", "child_category", "sales_price", "rating", "image_url"]


@dataclass
class FeatureModel:
    weights: dict
    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)
    brands: list = field(default_factory=list)
    colours: list = field(default_factory=list)
    vocab: list = field(default_factory=list)      # [(term, df, idf)]
    n_docs: int = 0
    stop_words: tuple | None = None                 # None -> the default list
    svd: object = None                              # simcat.operators.svd.SvdModel or None

    def block_dims(self) -> dict:
        return {"category": None, "text": (self.svd.k if self.svd is not None else len(self.vocab)),
                "numeric": len(NUMERIC_SPECS) * 2 + len(FLAG_COLUMNS),
                "brand": len(self.brands), "colour": len(self.colours)}


# --------------------------------------------------------------------------
# Column helpers
# --------------------------------------------------------------------------

def log1p_safe(c) -> Column:
    """log1p after clamping negatives to 0; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


def _numeric_raw(name: str, use_log: bool) -> Column:
    c = F.col(name).cast("double")
    return log1p_safe(c) if use_log else c


def category_tokens() -> Column:
    """``column=value`` one-hot tokens of the present category columns."""
    return F.filter(F.array(*[F.concat(F.lit(f"{c}="), F.col(c)) for c in CATEGORY_COLUMNS]),
                    lambda t: t.isNotNull())


# --------------------------------------------------------------------------
# Fit
# --------------------------------------------------------------------------

def fit_numeric(products: DataFrame) -> tuple[dict, dict, dict]:
    """(medians, means, scales); see ``fit_numeric_stats``."""
    return fit_numeric_stats(products)[:3]


def fit_numeric_stats(products: DataFrame) -> tuple[dict, dict, dict, int]:
    """Median of the (logged) present values per column (all missing -> 0), then the
    mean and population deviation of the imputed column (zero deviation -> 1)."""
    long = products.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), _numeric_raw(n, lg).alias("v"))
        for n, lg in NUMERIC_SPECS])).alias("s")).select("s.*").where(F.col("v").isNotNull())
    med = {r["name"]: r["q"] for r in quantiles(long, "name", "v", [0.5]).collect()}
    medians = {n: float(med.get(n, 0.0)) for n, _ in NUMERIC_SPECS}
    imputed = [F.coalesce(_numeric_raw(n, lg), F.lit(medians[n])) for n, lg in NUMERIC_SPECS]
    row = products.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(imputed)],
                       *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(imputed)],
                       F.count("*").alias("n")).first()
    means, scales = {}, {}
    for i, (n, _) in enumerate(NUMERIC_SPECS):
        means[n] = float(row[f"m{i}"] or 0.0)
        sd = float(row[f"s{i}"] or 0.0)
        scales[n] = sd if sd > 1e-12 else 1.0
    return medians, means, scales, int(row["n"])


def term_counts(docs: DataFrame, id_col: str = "product_id", text_col: str = "text",
                stop_words=None) -> DataFrame:
    """(id, term, tf) for unigrams and bigrams of each document.

    The aggregation is keyed by (id, term); when the input is already
    partitioned by id (as ``normalise`` leaves it) Spark adds no shuffle.
    """
    toks = docs.select(id_col, TX.tokens(text_col, list(stop_words) if stop_words else None)
                       .alias("_t"))
    grams = toks.select(id_col, F.explode(TX.with_bigrams("_t")).alias("term"))
    return grams.groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def top_terms(tf: DataFrame, min_df: int, max_features: int, many: bool = False) -> list:
    """[(term, document frequency)]: terms in >= min_df documents, then the max_features with the largest
    corpus count.

    Partial aggregation runs before the shuffle, so a term found in a third of
    all documents is still one row per map task.  ``many``: most terms are rare, as in long texts, and only those
    that can be among the max_features are exchanged.
    """
    counts = None
    if many:
        from simcat.operators.heavy_terms import near_terms
        counts = near_terms(tf, max_features, min_df)
    if counts is None:
        counts = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    stats = (counts.where(F.col("df") >= min_df)
             .orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features))
    return [(r["term"], int(r["df"])) for r in stats.collect()]


def with_idf(terms: list, n_docs: int) -> list:
    """[(term, df, idf)] with smooth idf = ln((1 + n) / (1 + df)) + 1."""
    return [(t, df, math.log((1.0 + n_docs) / (1.0 + df)) + 1.0) for t, df in terms]


def fit_vocabulary(tf: DataFrame, n_docs: int, min_df: int, max_features: int, many: bool = False) -> list:
    """The vocabulary with its idf; see ``top_terms``."""
    return with_idf(top_terms(tf, min_df, max_features, many), n_docs)


def fit_vocabularies(products: DataFrame, n_brands: int, n_colours: int) -> tuple[list, list]:
    """Top brands and top colour tokens in one job (count desc, value asc)."""
    from pyspark.sql.window import Window
    b = (products.where(F.col("brand").isNotNull() & (F.col("brand") != ""))
         .select(F.lit("b").alias("kind"), F.col("brand").alias("value")))
    c = products.select(F.lit("c").alias("kind"), F.explode("colour_tokens").alias("value"))
    freq = b.unionByName(c).groupBy("kind", "value").count()
    w = Window.partitionBy("kind").orderBy(F.col("count").desc(), F.col("value").asc())
    lim = F.when(F.col("kind") == "b", F.lit(n_brands)).otherwise(F.lit(n_colours))
    top = (freq.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= lim)
           .select("kind", "value", "rk").collect())          # at most n_brands + n_colours rows
    pick = lambda kind: [r["value"] for r in sorted((r for r in top if r["kind"] == kind),
                                                     key=lambda r: r["rk"])]
    return pick("b"), pick("c")


def together(spark, *steps):
    """Results of independent steps, whose jobs run side by side (each leaves cores idle at its end)."""
    with ThreadPoolExecutor(len(steps)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [r.result() for r in runs]


def fit(products: DataFrame, cfg: Config = Config(), tf=None) -> FeatureModel:
    """``tf``: the term counts, or a function that makes them; made from ``products`` without."""
    return _fit(products, cfg, tf)[0]


def _fit(products: DataFrame, cfg: Config, tf) -> tuple[FeatureModel, DataFrame]:
    weights = cfg.normalised_weights()
    model = FeatureModel(weights=weights, stop_words=cfg.stop_words)

    def terms():
        counts = tf() if callable(tf) else term_counts(products, stop_words=cfg.stop_words) if tf is None else tf
        return counts, top_terms(counts, cfg.tfidf_min_df, cfg.tfidf_max_features)

    numeric, (model.brands, model.colours), (tf, top) = together(
        products.sparkSession, lambda: fit_numeric_stats(products),
        lambda: fit_vocabularies(products, cfg.top_n_brands, cfg.top_n_colours), terms)
    model.medians, model.means, model.scales, model.n_docs = numeric
    model.vocab = with_idf(top, model.n_docs)
    if cfg.svd_components > 0 and len(model.vocab) > 1:
        from simcat.operators.svd import fit_svd
        k = min(cfg.svd_components, len(model.vocab) - 1)
        model.svd = fit_svd(tfidf(tf, model), model, k, cfg)
    return model, tf


# --------------------------------------------------------------------------
# Transform
# --------------------------------------------------------------------------

def vocab_frame(spark, model: FeatureModel) -> DataFrame:
    return spark.createDataFrame(
        [(t, i, float(idf)) for i, (t, _, idf) in enumerate(model.vocab)],
        "term string, term_idx int, idf double")


def tfidf(tf: DataFrame, model: FeatureModel, id_col: str = "product_id", parts: int = 0) -> DataFrame:
    """Long form (id, term, term_idx, w): sublinear tf x smooth idf, L2-normalised per id.

    ``parts``: partitions of the ids; by default as many as adaptive execution finds fit.
    """
    spark = tf.sparkSession
    vocab = F.broadcast(vocab_frame(spark, model))  # at most tfidf_max_features rows
    w = _of_terms(tf, [t for t, _, _ in model.vocab]).join(vocab, "term").select(
        id_col, "term", "term_idx", ((F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf")).alias("raw"))
    if parts:
        w = w.repartition(parts, id_col)
    from pyspark.sql.window import Window
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "term_idx", (F.col("raw") / norm).alias("w"))


def _of_terms(tf: DataFrame, terms: list[str]) -> DataFrame:
    """The rows of ``terms``; a packed table's other rows never leave the worker that unpacks them."""
    if "_blobs" not in tf.__dict__:
        return tf
    from simcat.session import map_columns

    def known(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        wanted = pa.array(terms, pa.string())
        for batch in batches:
            yield batch.filter(pc.is_in(batch.column("term"), value_set=wanted))
    return map_columns(tf, tf.columns, known, tf.schema)


def text_arrays(weights: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Collapse long-form weights to one row per id: terms and weights sorted by term."""
    return weights.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("term", "w"))).alias("_tw")).select(
        id_col, F.transform("_tw", lambda s: s["term"]).alias("text_terms"),
        F.transform("_tw", lambda s: s["w"]).alias("text_weights"))


def numeric_vector(model: FeatureModel) -> Column:
    """14 values (6 scaled, 6 missing flags, 2 Y/N flags), L2-normalised."""
    scaled, flags = [], []
    for n, lg in NUMERIC_SPECS:
        raw = _numeric_raw(n, lg)
        scaled.append((F.coalesce(raw, F.lit(model.medians[n])) - F.lit(model.means[n]))
                      / F.lit(model.scales[n]))
        flags.append(raw.isNull().cast("double"))
    extra = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FLAG_COLUMNS]
    return F.array(*scaled, *flags, *extra)


def literals(values: list[str]) -> str:
    """SQL string literals of any content; one expression instead of a call per value."""
    return ", ".join(f"CAST(X'{v.encode().hex()}' AS STRING)" for v in values)


def _unit(arr: Column) -> Column:
    from simcat.functions.vectors import l2_normalise
    return l2_normalise(arr)


def transform(products: DataFrame, model: FeatureModel, text_weights: DataFrame | None = None,
              with_features: bool = True) -> DataFrame:
    """Per product: block columns, presence flags, effective weights and the feature list."""
    spark = products.sparkSession
    if text_weights is None:
        text_weights = tfidf(term_counts(products, stop_words=model.stop_words), model)
    if model.svd is not None:
        from simcat.operators.svd import project
        text = project(text_weights, model.svd)          # product_id, text_vec
    else:
        text = text_arrays(text_weights)                  # product_id, text_terms, text_weights
    all_missing = F.lit(True)
    for n, lg in NUMERIC_SPECS:
        all_missing = all_missing & _numeric_raw(n, lg).isNull()
    brand_set = model.brands
    colour_set = model.colours
    base = products.select(
        "product_id", *[c for c in DISPLAY_COLUMNS if c != "product_id"],
        category_tokens().alias("cat_tokens"),
        numeric_vector(model).alias("_num_raw"),
        (~all_missing).alias("has_numeric"),
        (F.expr(f"CASE WHEN brand IN ({literals(brand_set)}) THEN brand END") if brand_set
         else F.lit(None).cast("string")).alias("brand_top"),
        (F.array_sort(F.array_distinct(F.expr(f"filter(colour_tokens, t -> t IN ({literals(colour_set)}))")))
         if colour_set else F.array().cast("array<string>")).alias("colour_top"),
    )
    base = base.withColumn("num_vec", _unit(F.col("_num_raw"))).drop("_num_raw")
    out = base.join(text, "product_id", "left")
    if model.svd is not None:
        has_text = F.col("text_vec").isNotNull()
    else:
        has_text = F.coalesce(F.size("text_terms") > 0, F.lit(False))
    out = out.withColumns({
        "has_category": F.size("cat_tokens") > 0,
        "has_text": has_text,
        "has_brand": F.col("brand_top").isNotNull(),
        "has_colour": F.size("colour_top") > 0,
    })
    w = model.weights
    avail = sum((F.col(f"has_{b}").cast("double") * F.lit(w[b]) for b in BLOCKS), F.lit(0.0))
    out = out.withColumn("_avail", avail).withColumns({
        f"eff_{b}": F.when(F.col("_avail") > 0,
                           F.col(f"has_{b}").cast("double") * F.lit(w[b]) / F.col("_avail"))
                     .otherwise(F.lit(0.0)) for b in BLOCKS}).drop("_avail")
    if with_features:
        out = with_feature_list(out, model)
    return out


def with_feature_list(feat: DataFrame, model: FeatureModel, scale: dict | None = None,
                      keys: str = "fkeys", vals: str = "fvals") -> DataFrame:
    """``fkeys``/``fvals``: every non-zero coordinate of the concatenated vector, each block scaled by
    ``scale`` (by default the square root of its effective weight)."""
    s = scale or {b: F.sqrt(F.col(f"eff_{b}")) for b in BLOCKS}
    kv = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    cat = F.transform("cat_tokens", lambda t: kv(F.concat(F.lit("c:"), t),
                                                 s["category"] / F.sqrt(F.size("cat_tokens"))))
    if model.svd is not None:
        text = F.transform(F.coalesce(F.col("text_vec"), F.array().cast("array<double>")),
                           lambda x, i: kv(F.concat(F.lit("s:"), i.cast("string")), s["text"] * x))
    else:
        text = F.zip_with(F.coalesce(F.col("text_terms"), F.array().cast("array<string>")),
                          F.coalesce(F.col("text_weights"), F.array().cast("array<double>")),
                          lambda t, x: kv(F.concat(F.lit("t:"), t), s["text"] * x))
    num = F.transform("num_vec", lambda x, i: kv(F.concat(F.lit("n:"), i.cast("string")),
                                                 s["numeric"] * x))
    brand = F.when(F.col("brand_top").isNotNull(),
                   F.array(kv(F.concat(F.lit("b:"), F.col("brand_top")), s["brand"]))) \
             .otherwise(F.array().cast("array<struct<k:string,v:double>>"))
    colour = F.transform("colour_top", lambda t: kv(F.concat(F.lit("o:"), t),
                                                    s["colour"] / F.sqrt(F.size("colour_top"))))
    allf = F.filter(F.concat(cat, text, num, brand, colour), lambda e: e["v"] != 0)
    return feat.withColumn("_f", allf).withColumns({
        keys: F.transform("_f", lambda e: e["k"]),
        vals: F.transform("_f", lambda e: e["v"])}).drop("_f")


def build_features(products: DataFrame, cfg: Config = Config(), materialise_inputs: bool = True,
                   with_features: bool = True, tf=None):
    """Fit and transform in one go: returns (features DataFrame, model).

    The product table and its term counts feed several aggregations, so they are
    written once to the shared checkpoint folder rather than recomputed (pass
    ``materialise_inputs=False`` and ``tf``, or a function that makes it, when the caller holds them).
    """
    from simcat.session import materialise
    if materialise_inputs:
        products = materialise(products)
        if tf is None:
            tf = lambda: materialise(term_counts(products, stop_words=cfg.stop_words))
    model, tf = _fit(products, cfg, tf)
    feats = transform(products, model, tfidf(tf, model), with_features=with_features)
    feats = materialise(feats)
    return feats, model
