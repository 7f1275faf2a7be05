"""Text-block operators on the documents table (whole texts, cleaned first)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from simcat.config import Config
from simcat.functions import parsers as P
from simcat.operators import features as FT
from simcat.plans import oracle as O
from simcat.plans.memo import memo
from simcat.plans.registry import register
from simcat.sources import read_table

DOC_CFG = Config()
TASK_BYTES = 2 << 20     # text whose terms one task counts, about


def doc_term_counts(spark, sf_dir):
    """(doc_id, term, tf) over every whole document, checkpointed once per session."""
    from simcat.session import free, packed

    def make():
        docs = read_table(spark, sf_dir, "documents", spread=True)
        size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
        # one exchange of the texts; the counts per document then need none
        parts = max(spark.sparkContext.defaultParallelism, math.ceil((size["bytes"] or 0) / TASK_BYTES))
        texts = docs.select("doc_id", P.clean_text("text").alias("text")).repartition(parts, "doc_id")
        tf = packed(FT.term_counts(texts, "doc_id", "text"))
        free(spark)
        return tf, size["n"]
    return memo(spark, ("doc_tf", sf_dir), make)


def doc_model(spark, sf_dir):
    def make():
        tf, n = doc_term_counts(spark, sf_dir)
        m = FT.FeatureModel(weights={}, n_docs=n)
        m.vocab = FT.fit_vocabulary(tf, n, DOC_CFG.tfidf_min_df, DOC_CFG.tfidf_max_features, many=True)
        return m
    return memo(spark, ("doc_model", sf_dir), make)


def _doc_views():
    tf = (f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({O.ngrams_of('t')}) AS term "
          f"FROM (SELECT doc_id, {O.tokens(O.clean_text('text'))} AS t FROM documents) a) b "
          f"GROUP BY doc_id, term")
    vocab = (f"SELECT term, df, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM "
             f"(SELECT term, count(*) AS df, sum(tf) AS cf FROM dtf GROUP BY term "
             f"HAVING count(*) >= {DOC_CFG.tfidf_min_df} ORDER BY cf DESC, term ASC "
             f"LIMIT {DOC_CFG.tfidf_max_features}) v, (SELECT count(*) AS n FROM documents) c")
    w = ("SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM "
         "(SELECT dtf.doc_id, dtf.term, (1.0::DOUBLE + ln(dtf.tf)) * dvocab.idf AS raw "
         "FROM dtf JOIN dvocab USING (term)) r")
    return [("dtf", tf), ("dvocab", vocab), ("dtfidf", w)]


@register("vocabulary_documents", lambda: O.with_views(
    "SELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM dvocab", *_doc_views()))
def q_vocabulary_documents(spark, sf_dir):
    """Terms in >= 3 documents, the 4,096 most frequent, with smooth idf."""
    m = doc_model(spark, sf_dir)
    rows = [(t, int(df), float(idf)) for t, df, idf in m.vocab]
    # the fitted vocabulary is bounded (max_features rows)
    v = spark.createDataFrame(rows, "term string, df bigint, idf double")
    return v.select("term", "df", F.round("idf", 6).alias("idf"))


@register("vocabulary_heavy", lambda: O.with_views(
    "SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM dtf GROUP BY term"
    f" HAVING count(*) >= {DOC_CFG.tfidf_min_df} ORDER BY cf DESC, term ASC LIMIT {DOC_CFG.tfidf_max_features}",
    *_doc_views()))
def q_vocabulary_heavy(spark, sf_dir):
    """The vocabulary of the documents with its counts, by heavy-hitter summaries and an exact recount."""
    from simcat.operators.heavy_terms import heavy_terms
    docs = read_table(spark, sf_dir, "documents", spread=True).select(P.clean_text("text").alias("text"))
    return heavy_terms(docs, DOC_CFG.tfidf_max_features, DOC_CFG.tfidf_min_df).terms


@register("tfidf_documents", lambda: O.with_views(
    "SELECT doc_id, CAST(count(*) AS BIGINT) AS n_terms, round(sum(w), 6) AS w_sum,"
    " round(max(w), 6) AS w_max FROM dtfidf GROUP BY doc_id", *_doc_views()))
def q_tfidf_documents(spark, sf_dir):
    """Per document: vocabulary terms present, sum and largest of its unit TF-IDF weights."""
    tf, _ = doc_term_counts(spark, sf_dir)
    w = FT.tfidf(tf, doc_model(spark, sf_dir), "doc_id", parts=tf.rdd.getNumPartitions())
    return w.groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.round(F.sum("w"), 6).alias("w_sum"),
                                   F.round(F.max("w"), 6).alias("w_max"))


def _once(batches):
    """Each value of a batch once."""
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).unique()], names=batch.schema.names)


@register("svd_documents")
def q_svd_documents(spark, sf_dir):
    """Truncated SVD of the documents' TF-IDF: components kept and explained variance."""
    from simcat.operators.svd import fit_svd
    from simcat.session import map_columns
    tf, _ = doc_term_counts(spark, sf_dir)
    m = doc_model(spark, sf_dir)
    k = min(DOC_CFG.svd_components, max(1, len(m.vocab) - 1))
    svd = memo(spark, ("doc_svd", sf_dir), lambda: fit_svd(
        FT.tfidf(tf, m, "doc_id", parts=tf.rdd.getNumPartitions()), m, k, DOC_CFG, id_col="doc_id"))
    ids = map_columns(tf, ["doc_id"], _once, tf.select("doc_id").schema)
    return ids.agg(F.count_distinct("doc_id").alias("n_documents")).select(
        "n_documents", F.lit(len(m.vocab)).cast("bigint").alias("n_terms"),
        F.lit(svd.k).cast("bigint").alias("n_components"),
        F.round(F.lit(svd.explained_variance_ratio), 6).alias("explained_variance"))
