"""Search queries: exact top-k for a basket of products, whole-catalogue kNN, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from simcat.config import Config
from simcat.operators import search as S
from simcat.plans import oracle as O
from simcat.plans.q_features import CFG_RAW, built, products
from simcat.plans.memo import memo
from simcat.plans.registry import register
from simcat.sources import read_table

K = 10

# The request set: every item of the most expensive order ("more like the
# items in this basket").  It is derived from orders and lineitem, so it moves
# with the data; the corpus is always the whole catalogue.
BASKET_SQL = ("SELECT CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_orderkey = "
              "(SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 1)")


def basket_ids(spark, sf_dir):
    top = (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
           .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(1))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (li.join(top, li.l_orderkey == top.o_orderkey, "left_semi")
            .select(F.col("l_partkey").cast("string").alias("product_id")).distinct())


def _features(spark, sf_dir, cfg=CFG_RAW):
    f, _ = built(spark, sf_dir, cfg)
    return f


@register("topk_exact", lambda: O.topk_sql(BASKET_SQL, K, CFG_RAW.weights), headline=True)
def q_topk_exact(spark, sf_dir):
    f = _features(spark, sf_dir)
    return S.similar(f, basket_ids(spark, sf_dir), K)


def _topk_ids_sql():
    inner = O.topk_sql(BASKET_SQL, K, CFG_RAW.weights)
    return (f"SELECT query_id, string_agg(product_id, '|' ORDER BY rank) AS ids FROM ({inner}) r "
            f"GROUP BY query_id")


@register("topk_ids", lambda: _topk_ids_sql())
def q_topk_ids(spark, sf_dir):
    f = _features(spark, sf_dir)
    r = S.ids_only(S.similar(f, basket_ids(spark, sf_dir), K))
    return r.select("query_id", F.array_join("ids", "|").alias("ids"))


@register("knn_all", lambda: O.topk_sql("SELECT product_id FROM products", K, CFG_RAW.weights),
          headline=True)
def q_knn_all(spark, sf_dir):
    """Top-10 similar products for every product of the catalogue."""
    f = _features(spark, sf_dir)
    return S.all_pairs(f, K)


CAT_ONLY = Config(svd_components=0, weights={"category": 1.0, "text": 0.0, "numeric": 0.0,
                                             "brand": 0.0, "colour": 0.0})


@register("topk_tiebreak", lambda: O.topk_sql("SELECT product_id FROM products", 5, CAT_ONLY.weights))
def q_topk_tiebreak(spark, sf_dir):
    """Category-only weights: scores tie in large groups, so the tie-break decides."""
    f, _ = built(spark, sf_dir, CAT_ONLY)
    return S.all_pairs(f, 5)


EMB_RANK = S.RankSpec(id_col="vec_id", id_type="bigint", tiebreak=(), carry=("label",),
                      keys_col="ekeys", vals_col="evals")


# The same vectors as a dense block, without keys: exact search multiplies matrices.
EMB_DENSE = S.RankSpec(id_col="vec_id", id_type="bigint", tiebreak=(), carry=("label",), keys_col="nokeys",
                       vals_col="novals", dense_col="evals")


def embedding_block(spark, sf_dir):
    """Each vector, unit-normalised, as a dense block beside an empty feature list."""
    from simcat.functions.vectors import l2_normalise
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", l2_normalise("embedding").alias("evals"),
                    F.array().cast("array<string>").alias("nokeys"), F.array().cast("array<double>").alias("novals"))


def embedding_features(spark, sf_dir):
    """Each vector as a feature list ("e:<dim>" -> unit-normalised value)."""
    from simcat.functions.vectors import l2_normalise
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    u = e.select("vec_id", "label", l2_normalise("embedding").alias("evals"))
    return u.select("vec_id", "label",
                    F.transform("evals", lambda x, i: F.concat(F.lit("e:"), i.cast("string"))).alias("ekeys"),
                    "evals")


_EMB_SQL = """WITH u AS (SELECT vec_id, label, CASE WHEN nrm = 0 THEN e ELSE list_transform(e, lambda x: x / nrm) END AS e
  FROM (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS nrm
        FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a) b)
SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, score, label FROM (
  SELECT a.vec_id AS query_id, b.vec_id, b.label, round(list_inner_product(a.e, b.e), 6) AS score,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_inner_product(a.e, b.e), 6) DESC,
                       b.vec_id ASC) AS rank
  FROM u a JOIN u b ON a.vec_id <> b.vec_id) r WHERE rank <= 10"""


@register("knn_embeddings", _EMB_SQL, headline=True)
def q_knn_embeddings(spark, sf_dir):
    """Top-10 cosine neighbours of every embedding vector."""
    return S.all_pairs(embedding_block(spark, sf_dir), 10, EMB_DENSE)


# ------------------------------------------------------------------ lookups
_LOOKUP_COLS = ["product_id", "product_name", "brand", "sales_price", "rating", "discount_percentage",
                "browsenode", "weight_grams", "sales_rank", "list_price", "child_category",
                "parent_category", "text", "is_prime", "is_best_seller", "image_url"]
REQUESTS_SQL = "SELECT ' ' || CAST(l_partkey AS VARCHAR) || ' ' AS request FROM lineitem"


def requests(spark, sf_dir):
    """Every part key ordered in lineitem, as padded text ids (lookups trim them)."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")).alias("request"))


@register("product_lookup", lambda: O.with_views(
    "SELECT " + ", ".join(_LOOKUP_COLS) + " FROM products WHERE product_id IN "
    f"(SELECT trim(request) FROM ({REQUESTS_SQL}) r)"))
def q_product_lookup(spark, sf_dir):
    """Products whose (trimmed) id was requested; list and dict fields left out."""
    p = products(spark, sf_dir)
    return S.lookup(p, requests(spark, sf_dir)).select(*_LOOKUP_COLS)


# Order keys as requested ids: they reach far beyond the part keys, so many are unknown.
ORDER_SQL = "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS request FROM orders"


def order_requests(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("request")).distinct()


@register("contains_ids", lambda: O.with_views(
    f"SELECT request, request IN (SELECT product_id FROM products) AS found FROM ({ORDER_SQL}) r"))
def q_contains_ids(spark, sf_dir):
    """Membership of each requested id (a left join against the id column)."""
    p = products(spark, sf_dir).select(F.col("product_id").alias("request"), F.lit(True).alias("_hit"))
    r = order_requests(spark, sf_dir)
    return r.join(p, "request", "left").select("request", F.coalesce("_hit", F.lit(False)).alias("found"))


@register("unknown_ids", lambda: O.with_views(
    f"SELECT trim(request) AS product_id FROM ({ORDER_SQL}) r WHERE trim(request) NOT IN "
    f"(SELECT product_id FROM products)"))
def q_unknown_ids(spark, sf_dir):
    return S.unknown_ids(products(spark, sf_dir), order_requests(spark, sf_dir))


# ------------------------------------------------------------------ default model (SVD text block)
CFG_DEFAULT = Config()


@register("topk_exact_svd")
def q_topk_exact_svd(spark, sf_dir):
    """The shipped model: text block reduced by truncated SVD (rows-only check)."""
    f, _ = built(spark, sf_dir, CFG_DEFAULT)
    return S.similar(f, basket_ids(spark, sf_dir), K)


@register("svd_text")
def q_svd_text(spark, sf_dir):
    """Per product: SVD text vector length and norm (unit when the product has text)."""
    f, _ = built(spark, sf_dir, CFG_DEFAULT, features=False)
    v = F.coalesce(F.col("text_vec"), F.array().cast("array<double>"))
    return f.select("product_id", F.size(v).cast("bigint").alias("dims"),
                    F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), 6).alias("norm"))


@register("svd_explained")
def q_svd_explained(spark, sf_dir):
    f, model = built(spark, sf_dir, CFG_DEFAULT, features=False)
    svd = model.svd
    return f.agg(F.count("*").alias("n_products")).select(
        "n_products", F.lit(len(model.vocab)).cast("bigint").alias("n_terms"),
        F.lit(svd.k if svd else 0).cast("bigint").alias("n_components"),
        F.round(F.lit(svd.explained_variance_ratio if svd else 1.0), 6).alias("explained_variance"))


CFG_SMALL_VOCAB = Config(svd_components=0, tfidf_max_features=100)


def _svd_inner_sql():
    from simcat.plans.q_features import fsql
    return fsql("""SELECT a.product_id, round(sum(a.w * b.w), 6) AS dot
FROM tfidf a JOIN tfidf b ON a.term = b.term
  AND TRY_CAST(b.product_id AS BIGINT) = TRY_CAST(a.product_id AS BIGINT) + 1
GROUP BY a.product_id HAVING round(sum(a.w * b.w), 6) > 0""", CFG_SMALL_VOCAB)


def _svd_full_rank(spark, sf_dir):
    """Products, TF-IDF rows and the SVD with as many components as terms (the 100 most frequent)."""
    from simcat.operators import features as FT
    from simcat.operators.svd import fit_svd
    from simcat.plans.q_features import checkpointed_inputs

    def make():
        p, tf = checkpointed_inputs(spark, sf_dir)
        model = FT.fit(p, CFG_SMALL_VOCAB, tf=tf)
        w = FT.tfidf(tf, model)
        return p, w, fit_svd(w, model, len(model.vocab), CFG_SMALL_VOCAB)
    return memo(spark, ("svd_full_rank", sf_dir), make)


@register("svd_inner_products", _svd_inner_sql)
def q_svd_inner_products(spark, sf_dir):
    """SVD with as many components as terms (the 100 most frequent): inner products of neighbouring
    products are those of the TF-IDF rows themselves, whatever the components' signs."""
    from simcat.functions.vectors import dot
    from simcat.operators import svd as V
    _, w, svd = _svd_full_rank(spark, sf_dir)
    vec = V.project(w, svd)
    n = F.col("product_id").try_cast("bigint")
    a = vec.select("product_id", n.alias("n"), F.col("text_vec").alias("va"))
    b = vec.select((n - 1).alias("n"), F.col("text_vec").alias("vb"))
    return (a.join(b, "n").select("product_id", F.round(dot("va", "vb"), 6).alias("dot"))
            .where(F.col("dot") > 0))


def _svd_variance_sql():
    from simcat.plans.q_features import fsql
    return fsql("""SELECT n AS n_products, CAST(count(*) AS BIGINT) AS n_terms,
  round(sum(s2 / n - (s1 / n) * (s1 / n)), 6) AS total_variance,
  round(sum(s2 / n - (s1 / n) * (s1 / n)), 6) AS explained_variance
FROM (SELECT term, sum(w) AS s1, sum(w * w) AS s2 FROM tfidf GROUP BY term) t,
     (SELECT count(*) AS n FROM feats) c GROUP BY n""", CFG_SMALL_VOCAB)


@register("svd_variance", _svd_variance_sql)
def q_svd_variance(spark, sf_dir):
    """Variance that as many components as terms explain: that of the TF-IDF columns."""
    p, w, svd = _svd_full_rank(spark, sf_dir)
    n_terms = w.agg(F.count_distinct("term").alias("n_terms"))
    return p.agg(F.count("*").alias("n_products")).select(
        "n_products", n_terms.scalar().alias("n_terms"),
        F.round(F.lit(svd.total_variance), 6).alias("total_variance"),
        F.round(F.lit(float(svd.explained_variance.sum())), 6).alias("explained_variance"))


def _features_sql():
    from simcat.plans.q_features import fsql
    effs = ", ".join(f"round(eff_{b}, 6) AS eff_{b}" for b in ("category", "text", "numeric", "brand", "colour"))
    return fsql(f"""SELECT product_id, CAST(
    (CASE WHEN eff_category > 0 THEN len(cat_tokens) ELSE 0 END)
  + (CASE WHEN eff_text > 0 THEN (SELECT count(*) FROM tfidf t WHERE t.product_id = f.product_id
                                  AND t.w <> 0) ELSE 0 END)
  + (CASE WHEN eff_numeric > 0 THEN len(list_filter(num_vec, lambda x: x <> 0)) ELSE 0 END)
  + (CASE WHEN eff_brand > 0 THEN 1 ELSE 0 END)
  + (CASE WHEN eff_colour > 0 THEN len(colour_top) ELSE 0 END) AS BIGINT) AS n_features, {effs}
FROM feats f""")


@register("features", _features_sql)
def q_features(spark, sf_dir):
    """The feature table: one row per product with its scaled sparse feature list size."""
    f, _ = built(spark, sf_dir)
    return f.select("product_id", F.size("fkeys").cast("bigint").alias("n_features"),
                    *[F.round(f"eff_{b}", 6).alias(f"eff_{b}") for b in
                      ("category", "text", "numeric", "brand", "colour")])


# ------------------------------------------------------------------ approximate search
def _ann(spark, sf_dir, cfg=CFG_RAW):
    from simcat.operators import ann as A
    f = _features(spark, sf_dir, cfg)
    return memo(spark, ("ann", sf_dir, repr(cfg)),
                lambda: A.build(f, cells=cfg.ann_cells, dims=cfg.ann_dims, seed=cfg.ann_seed))


@register("topk_ann", headline=True)
def q_topk_ann(spark, sf_dir):
    """Approximate top-10 for the basket: probe the nearest cells, rescore exactly."""
    from simcat.operators import ann as A
    f = _features(spark, sf_dir)
    idx = _ann(spark, sf_dir)
    return A.search(S.lookup(f, basket_ids(spark, sf_dir)), idx, K, nprobe=CFG_RAW.ann_nprobe)


@register("topk_ann_all_cells", lambda: O.topk_sql(BASKET_SQL, K, CFG_RAW.weights))
def q_topk_ann_all_cells(spark, sf_dir):
    """Approximate search with every cell probed: the exact result."""
    from simcat.operators import ann as A
    idx = _ann(spark, sf_dir)
    return A.search(S.lookup(_features(spark, sf_dir), basket_ids(spark, sf_dir)), idx, K,
                    nprobe=len(idx.centers))


RECALL_SAMPLE = 200


@register("recall_at_k", headline=True)
def q_recall_at_k(spark, sf_dir):
    """Recall@10 of the approximate search against exact, over 200 sampled products."""
    from simcat.operators import ann as A
    f = _features(spark, sf_dir)
    idx = _ann(spark, sf_dir)
    qf = S.lookup(f, A.sample_ids(f, RECALL_SAMPLE))
    n = min(RECALL_SAMPLE, f.count())
    ex = S.topk(qf, f, K)
    ap = A.search(qf, idx, K, nprobe=CFG_RAW.ann_nprobe)
    return A.recall_at_k(ex, ap, n, K)


@register("sample_ids", lambda: O.with_views(
    "SELECT product_id, substr(product_name, 1, 80) AS product_name FROM products WHERE product_id IN "
    "(SELECT product_id FROM products ORDER BY md5('42:' || product_id), product_id LIMIT 20)"))
def q_sample_ids(spark, sf_dir):
    """20 products in seeded hash order, name cut at 80 characters."""
    from simcat.operators import ann as A
    p = products(spark, sf_dir)
    ids = A.sample_ids(p, 20)
    return p.join(ids, "product_id", "left_semi").select(
        "product_id", F.substring("product_name", 1, 80).alias("product_name"))


def _index_stats_sql():
    from simcat.plans.q_features import fsql
    return fsql("""SELECT CAST(count(*) AS BIGINT) AS n_products,
  CAST((SELECT count(DISTINCT t) FROM (SELECT unnest(cat_tokens) AS t FROM feats) u)
       + (SELECT count(*) FROM vocab) + 14 + (SELECT count(*) FROM brands)
       + (SELECT count(*) FROM colours) AS BIGINT) AS n_dimensions,
  CAST(greatest(2, least(round(sqrt(count(*))), count(*))) AS BIGINT) AS ann_cells,
  true AS ann_ready FROM feats""")


@register("index_stats", _index_stats_sql)
def q_index_stats(spark, sf_dir):
    """Products, width of the concatenated feature vector, ANN cells."""
    f, model = built(spark, sf_dir)
    idx = _ann(spark, sf_dir)
    dims = model.block_dims()
    fixed = sum(v for b, v in dims.items() if b != "category" and v)
    cat_dims = f.select(F.explode("cat_tokens").alias("t")).select(F.count_distinct("t")).scalar()
    return f.agg(F.count("*").alias("n_products")).select(
        "n_products", (cat_dims + F.lit(fixed)).cast("bigint").alias("n_dimensions"),
        F.lit(len(idx.centers)).cast("bigint").alias("ann_cells"),
        F.lit(True).alias("ann_ready"))


def _overlap_sql():
    a = O.topk_sql(BASKET_SQL, K, CFG_RAW.weights)
    b = O.topk_sql(BASKET_SQL, K, CAT_ONLY.weights)
    return f"""SELECT x.query_id, CAST(len(list_intersect(x.ids, y.ids)) AS BIGINT) AS overlap
FROM (SELECT query_id, list(product_id) AS ids FROM ({a}) r GROUP BY query_id) x
JOIN (SELECT query_id, list(product_id) AS ids FROM ({b}) s GROUP BY query_id) y USING (query_id)"""


@register("topk_overlap", _overlap_sql)
def q_topk_overlap(spark, sf_dir):
    """Per basket item: how many of the top-10 under all blocks are also top-10 by category alone."""
    ids = basket_ids(spark, sf_dir)
    a = S.ids_only(S.similar(_features(spark, sf_dir), ids, K))
    fc, _ = built(spark, sf_dir, CAT_ONLY)
    b = S.ids_only(S.similar(fc, ids, K)).withColumnRenamed("ids", "ids_b")
    return a.join(b, "query_id").select(
        "query_id", F.size(F.array_intersect("ids", "ids_b")).cast("bigint").alias("overlap"))
