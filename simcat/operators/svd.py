"""Truncated SVD of the TF-IDF block by a randomized range finder (Halko et al. 2011).

The matrix A (products x vocabulary terms) stays distributed as one row per
product: (term_idx array, weight array).  Every pass is one Spark job:

* ``Y = A Z`` is computed inside each task from a broadcast Z (terms x l, bounded
  by the vocabulary size and the component count), and
* ``A^T Y`` (terms x l) and the triangle R of Y's QR decomposition (l x l) are emitted
  together.  Partial products are added up, and triangles are stacked and decomposed
  again, in a tree of at most ``FAN_IN`` parts per group (tall-skinny QR).

So the driver only ever holds terms x l and l x l matrices.  R has the singular values of Y
itself; a Gram matrix would have their squares and lose all below 1e-8 of the largest.
Component signs are arbitrary; inner products between projected rows are not affected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class SvdModel:
    components: np.ndarray      # k x terms
    k: int
    explained_variance_ratio: float
    explained_variance: np.ndarray      # per component, of the projected rows
    total_variance: float               # of all columns


def text_rows(weights: DataFrame, id_col: str = "product_id") -> DataFrame:
    """One row per document: sorted term indexes and their weights."""
    return weights.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("term_idx", "w"))).alias("_tw")).select(
        id_col, F.transform("_tw", lambda s: s["term_idx"]).alias("idx"),
        F.transform("_tw", lambda s: s["w"]).alias("val"))


def _row_block(pdf: pd.DataFrame, n_terms: int):
    """Rows of a batch as (row index, column index, value) triplets."""
    lens = np.fromiter((len(x) for x in pdf["idx"].values), dtype=np.int64, count=len(pdf))
    if lens.sum() == 0:
        return lens, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rows = np.repeat(np.arange(len(pdf)), lens)
    cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in pdf["idx"].values])
    vals = np.concatenate([np.asarray(x, dtype=np.float64) for x in pdf["val"].values])
    return lens, rows, cols, vals


CHUNK_VALUES = 1 << 14      # non-zeros multiplied at once
PASS_VALUES = 1 << 24       # non-zeros of a pass's task, about, where there are more tasks than cores
DENSE = 64                  # cells of a piece's matrix for each non-zero, at most
FAN_IN = 64                 # parts that meet in one group
BLOB_ROWS = 256             # rows of a partial sum that travel together


def _chunks(pdf: pd.DataFrame):
    """The batch in pieces of about CHUNK_VALUES non-zeros: (rows, row, column, value)."""
    lens = np.fromiter((len(x) for x in pdf["idx"].values), dtype=np.int64, count=len(pdf))
    piece = np.cumsum(lens) // CHUNK_VALUES
    for p in np.unique(piece):
        part = pdf.iloc[np.flatnonzero(piece == p)]
        _, r, c, v = _row_block(part, 0)
        yield len(part), r, c, v


def _matrix(n: int, r, c, v) -> tuple[np.ndarray, np.ndarray] | None:
    """(columns that occur, the piece over these as a matrix), unless it is too sparse to be worth one."""
    cols, at = np.unique(c, return_inverse=True)
    if not len(r) or n * len(cols) > DENSE * len(r):
        return None
    m = np.zeros((n, len(cols)))
    np.add.at(m, (r, at), v)
    return cols, m


def _times(n: int, r, c, v, z: np.ndarray) -> np.ndarray:
    """A Z for the rows of a piece."""
    if m := _matrix(n, r, c, v):
        return m[1] @ z[m[0]]
    out = np.zeros((n, z.shape[1]))
    if len(r):
        first = np.flatnonzero(np.diff(r, prepend=-1))
        out[r[first]] = np.add.reduceat(v[:, None] * z[c], first, axis=0)
    return out


def _add_transposed(out: np.ndarray, r, c, v, y: np.ndarray) -> None:
    """out += A^T Y for the rows of a piece."""
    if m := _matrix(len(y), r, c, v):
        out[m[0]] += m[1].T @ y
    elif len(r):
        order = np.argsort(c, kind="stable")
        col = c[order]
        first = np.flatnonzero(np.diff(col, prepend=-1))
        out[col[first]] += np.add.reduceat(v[order, None] * y[r[order]], first, axis=0)


def triangle(parts: list[np.ndarray], width: int) -> np.ndarray:
    """R of the QR decomposition of the stacked ``parts``."""
    return np.linalg.qr(np.vstack([np.zeros((0, width)), *parts]), mode="r")


def _one_pass(rows: DataFrame, fn, shape) -> tuple[np.ndarray, np.ndarray]:
    """Run ``fn(piece, out)`` over all pieces: the sum of the tasks' ``out`` (of ``shape``), and R of the
    rows that ``fn`` returned (none if it returns None).

    Each task emits ``out`` in blocks of ``BLOB_ROWS`` rows, and its triangle as block -1.  Parts meet in
    levels of at most ``FAN_IN`` per group, so no group grows with the number of tasks; the driver gets
    one matrix of ``shape`` and one triangle.
    """
    width = shape[1]

    def part(it):
        from pyspark import TaskContext
        acc, held, n = np.zeros(shape), [], 0
        for pdf in it:
            for piece in _chunks(pdf):
                y = fn(piece, acc)
                if y is not None:
                    held.append(y)
                    n += len(y)
                    if n > 4 * width:
                        held = [triangle(held, width)]
                        n = len(held[0])
        blobs = {a // BLOB_ROWS: acc[a:a + BLOB_ROWS] for a in range(0, shape[0], BLOB_ROWS)}
        if held:
            blobs[-1] = triangle(held, width)
        blobs = {k: m for k, m in blobs.items() if m.any()}
        yield pd.DataFrame({"block": np.array(list(blobs), dtype=np.int32),
                            "task": np.full(len(blobs), TaskContext.get().partitionId(), dtype=np.int32),
                            "m": [m.tobytes() for m in blobs.values()]})

    def meet(pdf):
        # in the order of the tasks, so that a sum doesn't depend on arrival
        pdf = pdf.sort_values("task")
        parts = [np.frombuffer(m).reshape(-1, width) for m in pdf["m"]]
        one = triangle(parts, width) if pdf["block"].iloc[0] < 0 else sum(parts)
        return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(),
                             "task": pdf["task"].iloc[:1].to_numpy() // FAN_IN, "m": [one.tobytes()]})

    schema = "block int, task int, m binary"
    parts = rows.mapInPandas(part, schema)
    n = rows.rdd.getNumPartitions()
    while n > FAN_IN:
        parts = parts.groupBy("block", F.floor(F.col("task") / FAN_IN)).applyInPandas(meet, schema)
        n = -(-n // FAN_IN)
    total, r = np.zeros(shape), np.zeros((0, width))
    for block, m in parts.groupBy("block").applyInPandas(meet, schema).select("block", "m").collect():
        m = np.frombuffer(m).reshape(-1, width)
        if block < 0:
            r = m
        else:
            total[block * BLOB_ROWS:block * BLOB_ROWS + len(m)] = m
    return total, r


def _in_few_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` in about as many tasks as there are cores, or ``PASS_VALUES`` non-zeros fill: each task of a pass
    writes a matrix of its own, whatever it reads."""
    n = rows.agg(F.sum(F.size("idx"))).first()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // PASS_VALUES))
    return rows.coalesce(tasks) if tasks < rows.rdd.getNumPartitions() else rows


def fit_svd(weights: DataFrame, model, k: int, cfg, id_col: str = "product_id") -> SvdModel:
    spark = weights.sparkSession
    sc = spark.sparkContext
    n_terms = len(model.vocab)
    n_docs = max(int(model.n_docs), 1)
    rows = text_rows(weights, id_col).select("idx", "val")
    from simcat.session import drop, free, materialise, spread
    free(spark)
    made = materialise(rows)
    dealt = spread(made)             # adaptive execution leaves a small table in fewer partitions than cores
    if dealt is not made:
        made, before = materialise(dealt), made
        drop(before)
    rows = _in_few_tasks(made)
    free(spark)
    l = min(n_terms, k + cfg.svd_oversample)
    rng = np.random.default_rng(cfg.svd_seed)
    z = rng.standard_normal((n_terms, l))
    for _ in range(cfg.svd_power_iters + 1):
        # With Y = Q R and R = U S V^T, (Q U) = Y V S^-1 is orthonormal and spans Y's columns, and
        # A^T (Q U) = (A^T Y) V S^-1 is formed on the driver.
        bz = sc.broadcast(np.linalg.qr(z)[0])

        def both(piece, out, bz=bz):
            n, r, c, v = piece
            y = _times(n, r, c, v, bz.value)
            _add_transposed(out, r, c, v, y)
            return y
        aty, r = _one_pass(rows, both, z.shape)
        free(spark)
        _, sv, vt = np.linalg.svd(r, full_matrices=False)
        keep = sv > sv.max(initial=0.0) * 1e-12
        z = aty @ (vt[keep].T / sv[keep])
        bz.unpersist()
        if not z.shape[1]:       # no row has a weight
            break
    # B = Q^T A = z^T (l' x terms); its right singular vectors span the row space
    _, s, vt = np.linalg.svd(z.T, full_matrices=False)
    comps = vt[:k]
    if comps.shape[0] < k:
        # A has lower rank than k: the remaining components carry no variance
        comps = np.vstack([comps, np.zeros((k - comps.shape[0], n_terms))])
    # explained variance: variance of projected columns over total column variance
    bc = sc.broadcast(np.ascontiguousarray(comps.T))

    def moments(piece, out, bc=bc):
        n, r, c, v = piece
        p = _times(n, r, c, v, bc.value)
        out[0, :k] += p.sum(axis=0)
        out[1, :k] += (p * p).sum(axis=0)
        out[2, :n_terms] += np.bincount(c, weights=v, minlength=n_terms)
        out[3, :n_terms] += np.bincount(c, weights=v * v, minlength=n_terms)
    mo, _ = _one_pass(rows, moments, (4, max(n_terms, k)))
    drop(made)
    proj_var = mo[1, :k] / n_docs - (mo[0, :k] / n_docs) ** 2
    full_var = mo[3, :n_terms] / n_docs - (mo[2, :n_terms] / n_docs) ** 2
    ratio = float(proj_var.sum() / full_var.sum()) if full_var.sum() > 0 else 0.0
    bc.unpersist()
    return SvdModel(components=comps, k=int(comps.shape[0]), explained_variance_ratio=ratio,
                    explained_variance=proj_var, total_variance=float(full_var.sum()))


def project(weights: DataFrame, svd: SvdModel, id_col: str = "product_id") -> DataFrame:
    """(id, text_vec): each document's TF-IDF row times the components, L2-normalised."""
    sc = weights.sparkSession.sparkContext
    bc = sc.broadcast(np.ascontiguousarray(svd.components.T))     # terms x k
    rows = text_rows(weights, id_col)

    def proj(it):
        z = bc.value
        for pdf in it:
            at = 0
            for n, r, c, v in _chunks(pdf):
                p = _times(n, r, c, v, z)
                nrm = np.linalg.norm(p, axis=1, keepdims=True)
                p = np.where(nrm > 0, p / np.where(nrm > 0, nrm, 1.0), p)
                yield pd.DataFrame({id_col: pdf[id_col].values[at:at + n], "text_vec": list(p)})
                at += n
    id_type = weights.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(proj, f"{id_col} {id_type}, text_vec array<double>")
