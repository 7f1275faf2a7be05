"""Text quality by positive-unlabelled learning (non-negative unbiased risk).

Trusted positives are labelled rows of good quality of the training fold; the unlabelled rows are a sample of
``documents`` of that fold, with a label or without, whose labels are never read.  The class prior of the unlabelled rows is
estimated from a first classifier of positives against unlabelled rows (the lowest ratio of the
two classes' shares above a threshold, plus its standard error) and again from the scores of held-back rows under the
minimum of the risk; a linear model minimises the non-negative risk: prior * loss(positives) + max(0, loss of unlabelled rows as
negatives - prior * loss of positives as negatives), with a loss between 0 and 1.  The score is that model's probability.

A text's features are counts over all its bytes and words: bytes, hashed byte pairs, and a few
ratios.  Parameters: ``MAX_FIT`` bounds the labelled rows used for fitting and ``MAX_UNLABELLED`` the unlabelled ones
(smallest hashes of doc_id; of rows that repeat an id one is used); everything else reads all rows and whole texts.

Defined results: null text counts as empty and is scored too; without positive training rows every
score is 0.5; of repeated labels for a document the highest counts; extra columns are ignored.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import crc_mod, small_batches, table
from simcat.llm.toxicity import training_rows

FOLDS, HELD_OUT = 5, 0
MAX_FIT = 12_000
MAX_UNLABELLED = 12_000
PAIRS = 512
EXTRA = 8
WIDTH = 256 + PAIRS + EXTRA
CUT = 0.3
EPOCHS = 300
SCALE, DECAY = 4.0, 1e-3
AGAIN = 2               # times that the prior is estimated again


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(WIDTH, dtype=np.float32)
    if not raw:
        return out
    b = np.frombuffer(raw, dtype=np.uint8)
    n = len(b)
    hist = np.bincount(b, minlength=256)
    out[:256] = np.sqrt(hist / n)
    if n > 1:
        pair = (b[:-1].astype(np.uint16) * np.uint16(40503) ^ b[1:] * np.uint16(2477)) >> np.uint16(7)
        out[256:256 + PAIRS] = np.sqrt(np.bincount(pair, minlength=PAIRS) / (n - 1))
    words = raw.split()
    m = max(1, len(words))
    letters = int(hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum())
    out[256 + PAIRS:] = (
        min(1.0, math.log1p(n) / 12), len(set(words)) / m,
        sum(map(eq, words, words[1:])) / m, min(1.0, n / m / 20),
        hist[65:91].sum() / max(1, letters), letters / n, hist[48:58].sum() / n, hist[10] / n)
    return out


def _log_loss(z):
    """log(1 + exp(-z)) and its derivative."""
    return np.logaddexp(0, -z), -1.0 / (1.0 + np.exp(np.clip(z, -60, 60)))


def _loss(z):
    """The bounded loss of the risk, 1 / (1 + exp(z)), and its derivative."""
    s = 1.0 / (1.0 + np.exp(np.clip(z, -60, 60)))
    return s, -s * (1 - s)


def _adam(grad_fn, w, epochs, rate=0.05):
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, epochs + 1):
        g = grad_fn(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among ``unl`` from scores of held-back positives and unlabelled rows."""
    best = 1.0
    for t in np.quantile(pos, np.linspace(0.02, 0.6, 30)):
        p = float((pos >= t).mean())
        u = float((unl >= t).mean())
        ratio = u / max(1e-6, p)
        error = math.sqrt(u * (1 - u) / max(1, len(unl)) + ratio ** 2 * p * (1 - p) / max(1, len(pos)))
        best = min(best, ratio + error / max(1e-6, p))
    return float(np.clip(best, 0.05, 0.95))


def train(x_pos: np.ndarray, x_unl: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (last one the bias) and the estimated prior."""
    one = lambda x: np.hstack([x * SCALE, np.ones((len(x), 1), np.float32)])
    xp, xu = one(x_pos), one(x_unl)

    def separate(w):
        # positives against unlabelled rows, both classes weighing the same
        gp, gu = _log_loss(xp[::2] @ w)[1], -_log_loss(-(xu[::2] @ w))[1]
        return xp[::2].T @ gp / len(gp) + xu[::2].T @ gu / len(gu) + DECAY * w

    w = _adam(separate, np.zeros(xp.shape[1], np.float32), EPOCHS)
    back_p, back_u = (xp[1::2], xu[1::2]) if len(xp) > 1 and len(xu) > 1 else (xp, xu)
    prior = estimate_prior(back_p @ w, back_u @ w)

    def minimise(p, u):
        return _adam(lambda v: risk(v, p, u, prior)[1], np.zeros(xp.shape[1], np.float32), EPOCHS)

    for _ in range(AGAIN):
        # the risk's own minimum tells the classes apart better than the first classifier
        w = minimise(xp[::2], xu[::2])
        prior = min(prior, estimate_prior(back_p @ w, back_u @ w))
    w = minimise(xp, xu)
    return np.append(w[:-1] * SCALE, w[-1]), prior


def risk(w, xp, xu, prior: float):
    """The non-negative risk with its decay, and its gradient (the clipped part is flat)."""
    zp, zu = xp @ w, xu @ w
    (lp, dp), (ln, dn), (lu, du) = _loss(zp), _loss(-zp), _loss(-zu)
    value = prior * lp.mean() + DECAY / 2 * float(w @ w)
    grad = prior * (xp.T @ dp) / len(xp) + DECAY * w
    negative = lu.mean() - prior * ln.mean()
    if negative > 0:
        value += negative
        grad = grad - (xu.T @ du) / len(xu) + prior * (xp.T @ dn) / len(xp)
    return value, grad


def unlabelled_rows(docs: DataFrame, limit: int) -> DataFrame:
    """``doc_id`` and ``text`` of a sample of the training fold's documents: at most ``limit`` ids."""
    ids = (docs.select(F.col("doc_id").cast("long").alias("doc_id"))
           .filter(F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")


def _features_of(rows: DataFrame, limit: int) -> np.ndarray:
    """Features of at most ``limit`` ids, one row for each."""
    def make(batches):
        for batch in batches:
            x = [features(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(x, pa.binary())], names=["doc_id", "x"])

    got = (rows.select("doc_id", "text").mapInArrow(make, "doc_id long, x binary")
           .groupBy("doc_id").agg(F.max("x").alias("x")).orderBy("doc_id").limit(limit).collect())
    return np.frombuffer(b"".join(r["x"] for r in got), dtype=np.float32).reshape(len(got), WIDTH)


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT,
        max_unlabelled: int = MAX_UNLABELLED) -> np.ndarray | None:
    small_batches(docs.sparkSession)
    positive = _features_of(training_rows(docs, labels, "quality", FOLDS, HELD_OUT, max_fit).filter("y = 1"), max_fit)
    if not len(positive):
        return None
    return train(positive, _features_of(unlabelled_rows(docs, max_unlabelled), max_unlabelled))[0]


def score(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    if weights is None:
        return docs.select(F.col("doc_id").cast("long"), F.lit(0.5).alias("score"))
    shared = spark.sparkContext.broadcast(np.asarray(weights, dtype=np.float64))  # WIDTH + 1 numbers

    def run(batches):
        w = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([features(t.as_py()) for t in batch.column(1)])
            z = np.clip(x @ w[:-1] + w[-1], -60, 60)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1.0 / (1.0 + np.exp(-z)), pa.float64())],
                names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
