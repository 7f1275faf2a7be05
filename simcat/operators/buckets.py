"""Approximate top-k without fitted centres: sign-projection buckets in several tables.

Build: every row gets one code of ``bits`` signs per table, from random directions drawn from the
feature keys' hashes (``signs``).  Nothing is fitted, so rows can be added at any time, and the codes
stand beside the feature lists in one table.

Search: a query looks into its own bucket of each table and into the buckets that differ in the signs
it is least sure of (smallest sum of the flipped projections), ``probes`` of them per table.  Query chunks are
broadcast with a map (table, code) -> queries; every task matches its rows' codes against that map, so the
equality join happens where the rows lie: a bucket with a third of the rows is spread over all tasks
that hold them, and a row found through several tables is scored once.  Scores and ranking are those
of exact search; with every bucket probed the result is the exact one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simcat.operators import search as S
from simcat.operators import signs as G
from simcat.operators.nn_descent import Lists
from simcat.operators.search import PRODUCT_RANK, RankSpec

TABLES = 8
PROBES = 12
MAX_BITS = 12
BUCKET_ROWS = 32         # rows of a bucket that the default number of bits aims at
FLIPS = 8                # signs that may be flipped, the least sure ones


@dataclass
class BucketIndex:
    rows: DataFrame      # corpus columns + codes
    tables: int
    bits: int
    seed: int
    spec: RankSpec


def default_bits(n: int) -> int:
    return int(min(MAX_BITS, max(2, round(math.log2(max(n, 1) / BUCKET_ROWS + 1)))))


def build(corpus: DataFrame, spec: RankSpec = PRODUCT_RANK, tables: int = TABLES, bits: int = 0,
          seed: int = 42) -> BucketIndex:
    """One pass over the corpus; no exchange but that of a small table over the cores."""
    from simcat.session import materialise, spread
    if spec.dense_col:
        raise ValueError("sign buckets take feature lists; give a dense block as one")
    bits = bits or default_bits(corpus.count())
    if not 1 <= bits <= MAX_BITS or tables < 1:
        raise ValueError(f"needs at least one table and 1 to {MAX_BITS} bits")
    own = [c for c in (*spec.carry, *[c for c, _, _ in spec.tiebreak]) if c != spec.id_col]
    side = S.query_side(spread(corpus), spec, *[F.col(c).alias(c) for c in dict.fromkeys(own)])
    return BucketIndex(materialise(G.with_codes(side, spec, tables, bits, seed)), tables, bits, seed, spec)


def probed_codes(p: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` codes of one table that each row of projections ``p`` looks into: queries x probes.

    A set of flipped signs costs the sum of their projections' sizes; the cheapest sets come first.
    """
    bits = p.shape[1]
    probes = min(probes, 1 << bits)
    own = G.pack(p >= 0)
    m = bits if probes > 1 << min(bits, FLIPS) else min(bits, FLIPS)
    near = np.argsort(np.abs(p), axis=1, kind="stable")[:, :m]
    sets = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1                       # subsets x m
    cost = np.take_along_axis(np.abs(p), near, axis=1) @ sets.T.astype(np.float64)
    pick = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    weight = (1 << (bits - 1 - near)).astype(np.int64)                            # queries x m
    flip = np.einsum("qpm,qm->qp", sets[pick].astype(np.int64), weight)
    return own[:, None] ^ flip


def probe_map(q: pd.DataFrame, index: BucketIndex, probes: int) -> list[dict]:
    """Per table: code -> positions of the queries that look into its bucket."""
    p = G.project(q, index.spec, index.tables * index.bits, index.seed)
    out = []
    for t in range(index.tables):
        codes = probed_codes(p[:, t * index.bits:(t + 1) * index.bits], probes)
        which = np.repeat(np.arange(len(q)), codes.shape[1])
        order = np.argsort(codes.ravel(), kind="stable")
        code, at = codes.ravel()[order], which[order]
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        out.append(dict(zip(code[start].tolist(), np.split(at, start[1:]))))
    return out


def matches(codes: np.ndarray, wanted: list[dict], n_queries: int) -> np.ndarray:
    """Queries x rows: the row lies in a probed bucket of some table."""
    hit = np.zeros((n_queries, len(codes)), dtype=bool)
    for t, queries_of in enumerate(wanted):
        order = np.argsort(codes[:, t], kind="stable")
        code = codes[order, t]
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        for c, rows in zip(code[start].tolist(), np.split(order, start[1:])):
            if c in queries_of:
                hit[queries_of[c][:, None], rows[None, :]] = True
    return hit


def _best(q: pd.DataFrame, c: pd.DataFrame, hit: np.ndarray, k: int, spec: RankSpec) -> pd.DataFrame:
    """Exact scores of the matched pairs; per query those that can be among its best ``k``."""
    held, found = Lists(c, spec), []
    for i, (keys, vals) in enumerate(zip(q[spec.keys_col], q[spec.vals_col])):
        rows = np.flatnonzero(hit[i])
        if len(rows):
            s = np.round(held.scores(np.asarray(keys, np.int64), np.asarray(vals, float), rows), spec.score_places)
            keep = s >= (np.partition(s, -k)[-k] if len(s) > k else -np.inf)
            found.append((np.full(keep.sum(), i), rows[keep], s[keep]))
    if not found:
        return S._empty(spec)
    i, j, s = (np.concatenate(x) for x in zip(*found))
    out = {"query_id": q[spec.id_col].to_numpy()[i], spec.id_col: c[spec.id_col].to_numpy()[j], "score": s}
    return pd.DataFrame(out | {t: c[t].to_numpy(dtype=np.float64)[j] for t, _, _ in spec.tiebreak})


def search(queries: DataFrame, index: BucketIndex, k: int, probes: int = PROBES,
           block_rows: int = S.BLOCK_ROWS) -> DataFrame:
    """Approximate top-k of the indexed rows for each row of ``queries`` (with its feature list)."""
    spec = index.spec
    if k <= 0:
        return S.no_result(index.rows, spec)
    more = k + 1 if spec.exclude_self else k      # the query itself may be among the best
    cand = index.rows.select(spec.id_col, spec.keys_col, spec.vals_col, "codes",
                             *[F.col(c).cast("double").alias(c) for c, _, _ in spec.tiebreak])

    def finish(shared):
        def score(batches):
            q = shared.value
            if probes >= 1 << index_parts.bits:      # all rows match, whatever their code
                yield from S.scan((pdf.drop(columns="codes") for pdf in batches), q, k, spec, block_rows)
                return
            wanted, best = probe_map(q, index_parts, probes), None
            for pdf in batches:
                for start in range(0, len(pdf), block_rows):
                    c = pdf.iloc[start:start + block_rows]
                    part = _best(q, c, matches(np.stack(c["codes"].values), wanted, len(q)), more, spec)
                    if spec.exclude_self:
                        part = part[part["query_id"].to_numpy() != part[spec.id_col].to_numpy()]
                    best = part if best is None else S.merge_topk(best, part, k, spec)
            if best is not None and len(best):
                yield best
        return S.rank_final(cand.mapInPandas(score, S._result_schema(spec)), k, spec)

    index_parts = BucketIndex(None, index.tables, index.bits, index.seed, spec)     # what tasks need of it
    ranked = S.in_chunks(S.query_side(queries, spec), spec.id_col, finish, block_rows)
    return S.no_result(index.rows, spec) if ranked is None else S.with_columns(ranked, index.rows, spec)
