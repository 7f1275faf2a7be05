"""Language identification with a small byte convolutional network, trained in numpy.

A text's bytes are cut into windows of ``WINDOW`` bytes.  Per window: byte embeddings, filters of
several widths, the maximum over positions, softmax.  A text's language is the one with the highest
mean probability over all its windows, weighted by their bytes.

For inference the embedding and the filters are folded into tables of byte pairs, which give the
same numbers as the convolution.  Parameters: ``MAX_FIT`` bounds the labelled rows used for
fitting (smallest hashes of doc_id).

Defined results: null texts and texts without a letter are ``und`` with score 0; without labelled
rows every text is ``und``; ties go to the language first in order; a repeated ``doc_id`` is scored
row by row; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import crc_mod, small_batches, table

FOLDS, HELD_OUT = 4, 2
MAX_FIT = 6_000
WINDOW = 256
TRAIN_WINDOWS = 3       # windows of one training text, evenly spread
EMBED, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
STEPS, BATCH = 500, 128
LETTER = re.compile(r"[^\W\d_]")
BLOCK = 128             # windows scored at once


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of ``text`` (zero-padded) and their numbers of bytes."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = -(-len(raw) // WINDOW)
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(raw)] = raw
    size = np.full(n, WINDOW)
    size[-1:] = len(raw) - (n - 1) * WINDOW
    return out.reshape(n, WINDOW), size


class Network:
    @classmethod
    def of(cls, state: dict) -> "Network":
        """The network with these attributes (``vars`` of a fitted one)."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def __init__(self, langs: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"embed": rng.normal(0, 0.3, (256, EMBED)).astype(np.float32),
                  "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32),
                  "bias": np.zeros(len(langs), np.float32)}
        for w in WIDTHS:
            self.p[f"conv{w}"] = rng.normal(0, 0.3, (w, EMBED, FILTERS)).astype(np.float32)
            self.p[f"shift{w}"] = np.zeros(FILTERS, np.float32)

    def forward(self, x: np.ndarray):
        """Softmax of windows ``x`` with what the backward pass needs."""
        e = self.p["embed"][x]
        pooled, where = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            z = sum(e[:, k:k + n] @ self.p[f"conv{w}"][k] for k in range(w))
            at = z.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0] + self.p[f"shift{w}"])
        h = np.hstack(pooled)
        act = np.maximum(h, 0)
        return _softmax(act @ self.p["out"] + self.p["bias"]), (x, e, where, h, act)

    def gradients(self, prob, y, kept):
        x, e, where, h, act = kept
        d = prob.copy()
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"out": act.T @ d, "bias": d.sum(axis=0), "embed": np.zeros_like(self.p["embed"])}
        dh = (d @ self.p["out"].T) * (h > 0)
        row = np.arange(len(y))[:, None]
        for i, w in enumerate(WIDTHS):
            part = dh[:, i * FILTERS:(i + 1) * FILTERS]
            g[f"shift{w}"] = part.sum(axis=0)
            conv = np.zeros_like(self.p[f"conv{w}"])
            for k in range(w):
                at = where[i] + k                       # the byte under tap k, per filter
                conv[k] = np.einsum("bfe,bf->ef", e[row, at], part)
                back = part[:, :, None] * self.p[f"conv{w}"][k].T[None]
                np.add.at(g["embed"], x[row, at], back)
            g[f"conv{w}"] = conv
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.01):
        rng = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), BATCH)
            prob, kept = self.forward(x[pick])
            for k, g in self.gradients(prob, y[pick], kept).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def tables(self):
        """Filters by byte pair: the embedding folded into the taps, two taps at a time."""
        out = []
        for w in WIDTHS:
            taps = [self.p["embed"] @ self.p[f"conv{w}"][k] for k in range(w)]
            parts = []
            for k in range(0, w - 1, 2):
                parts.append((k, (taps[k][:, None] + taps[k + 1][None]).reshape(65536, FILTERS)
                              .astype(np.float32)))
            if w % 2:
                parts.append((w - 1, taps[w - 1].astype(np.float32)))
            out.append((w, parts))
        return out

    def probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w, parts in tables:
            n = x.shape[1] - w + 1
            z = None
            for k, t in parts:
                add = t.take((pair if len(t) == 65536 else x)[:, k:k + n], axis=0)
                z = add if z is None else np.add(z, add, out=z)
            pooled.append(z.max(axis=1) + self.p[f"shift{w}"])
        return _softmax(np.maximum(np.hstack(pooled), 0) @ self.p["out"] + self.p["bias"])


def _softmax(z):
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, max_fit: int = MAX_FIT) -> Network | None:
    """Train on labelled texts of the training fold."""
    chosen = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                          & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT))
              .select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct()
              .orderBy("h", "doc_id", "lang").limit(max_fit).drop("h"))
    # at most max_fit ids: the size of the broadcast is a parameter
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])

    def cut(batches):
        for batch in batches:
            lang, x = [], []
            for label, t in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if not t.as_py() or not LETTER.search(t.as_py()):
                    continue
                parts, _ = windows(t.as_py())
                for i in sorted({int(j * len(parts) / TRAIN_WINDOWS) for j in range(TRAIN_WINDOWS)}):
                    lang.append(label)
                    x.append(parts[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(x, pa.binary())],
                                             names=["lang", "x"])

    small_batches(docs.sparkSession)
    got = rows.mapInArrow(cut, "lang string, x binary").collect()   # max_fit * TRAIN_WINDOWS rows
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], r["x"]))
    langs = sorted({r["lang"] for r in got})
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.uint8).reshape(len(got), WINDOW)
    y = np.array([langs.index(r["lang"]) for r in got])
    return Network(langs).train(x, y)


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    # a fixed number of weights, as plain arrays: a broadcast object would need this package on the executors
    shared = spark.sparkContext.broadcast(None if net is None else vars(net))

    def run(batches):
        model = None if shared.value is None else Network.of(shared.value)
        tables = model.tables() if model else None
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            queue: list = []          # windows waiting, with their text and bytes
            total = np.zeros((len(texts), len(model.langs) if model else 1))

            def flush():
                x = np.concatenate([q[0] for q in queue])
                own = np.concatenate([q[1] for q in queue])
                size = np.concatenate([q[2] for q in queue])
                for a in range(0, len(x), BLOCK):
                    prob = model.probabilities(x[a:a + BLOCK], tables)
                    np.add.at(total, own[a:a + BLOCK], prob * size[a:a + BLOCK, None])
                queue.clear()

            held = 0
            for i, t in enumerate(texts):
                if model and t and LETTER.search(t):
                    lang[i] = ""
                    parts, size = windows(t)
                    queue.append((parts, np.full(len(parts), i), size))
                    held += len(parts)
                    if held > 16 * BLOCK:
                        flush()
                        held = 0
            if queue:
                flush()
            for i in range(len(texts)):
                if lang[i] == "":
                    best = int(total[i].argmax())
                    lang[i] = model.langs[best]
                    score[i] = min(1.0, float(total[i, best] / total[i].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "lang_pred", "score")
