"""Diverse results: at most so many rows of a brand, and maximal marginal relevance.

``capped`` returns the best ``k`` rows of the ranking order of which at most ``cap`` share a group (a
brand).  It fetches the exact top ``m``, applies the cap, and is done with a query once ``k`` rows pass:
what was not fetched ranks below all of them.  Queries that fall short fetch ``GROW`` times as many.
After ``WIDEN`` rounds the rest (queries whose neighbourhood is one brand) are answered in one pass that
keeps the best ``cap`` rows of every group, whatever their rank.  The result is exact in both cases.

``mmr`` reorders each query's best ``pool`` rows: the next row is the one with the largest
``balance * score - (1 - balance) * (largest similarity to a row chosen before)``, by the same score
function; ties go to the better original rank.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from simcat.operators import search as S
from simcat.operators.search import PRODUCT_RANK, RankSpec

GROW = 4
WIDEN = 2


def _cap(ranked: DataFrame, k: int, cap: int, group: str, spec: RankSpec) -> DataFrame:
    """The first ``k`` rows per query of which at most ``cap`` share a group; no group, no limit."""
    in_group = Window.partitionBy("query_id", group).orderBy(*S.order_columns(spec))
    passed = (ranked.withColumn("_g", F.row_number().over(in_group))
              .where(F.col(group).isNull() | (F.col("_g") <= cap)).drop("_g"))
    return S.rank_final(passed, k, spec)


def _per_group(queries: DataFrame, corpus: DataFrame, k: int, cap: int, group: str, spec: RankSpec,
               block_rows: int) -> DataFrame | None:
    """One pass that keeps every group's best: exact however deep the ``k``-th row lies."""
    schema = f"{S._result_schema(spec)}, {group} string"
    cand = S.candidate_side(corpus, spec, F.col(group).alias(group))

    def trim(best: pd.DataFrame) -> pd.DataFrame:
        """The best ``cap`` rows per query and group, the best ``k`` of those without a group."""
        keys = [best[spec.id_col].rank(method="first").to_numpy()]
        for col, order, fill in reversed(spec.tiebreak):
            v = best[col].to_numpy(dtype=np.float64)
            v = np.where(np.isnan(v), fill, v)
            keys.append(-v if order == "desc" else v)
        best = best.iloc[np.lexsort([*keys, -best["score"].to_numpy()])]
        nth = best.groupby(["query_id", group], sort=False, dropna=False).cumcount()
        return best[nth < best[group].isna().map({True: k, False: min(cap, k)})]

    def finish(shared):
        def score(batches):
            prepared, best = S.Prepared(shared.value, spec), None
            for pdf in batches:
                for start in range(0, len(pdf), block_rows):
                    c = pdf.iloc[start:start + block_rows]
                    groups = pd.Series(c[group].to_numpy(), index=pd.Index(c[spec.id_col]))
                    pieces = []
                    for _, rows in c.groupby(group, sort=False, dropna=False):
                        top = prepared.topk(rows, k if pd.isna(rows[group].iloc[0]) else min(cap, k))
                        pieces.append(top.assign(**{group: groups.reindex(top[spec.id_col]).to_numpy()}))
                    best = trim(pd.concat([*([] if best is None else [best]), *pieces], ignore_index=True))
            if best is not None and len(best):
                yield best
        return _cap(cand.mapInPandas(score, schema), k, cap, group, spec).drop(group)
    return S.in_chunks(S.query_side(queries, spec), spec.id_col, finish, block_rows)


def capped(queries: DataFrame, corpus: DataFrame, k: int, cap: int, group: str = "brand",
           spec: RankSpec = PRODUCT_RANK, block_rows: int = S.BLOCK_ROWS, widen: int = WIDEN) -> DataFrame:
    """Exact top-k with at most ``cap`` rows per value of ``group``; columns as in ``search.topk``."""
    from simcat.session import materialise
    if k <= 0 or cap < 0:
        return S.no_result(corpus, spec)
    if group not in spec.carry:
        raise ValueError(f"{group!r} must be a carried column")
    rows = corpus.count()
    pending = materialise(queries.select(spec.id_col, spec.keys_col, spec.vals_col))
    done, m = [], 2 * k
    for _ in range(widen):
        wide = S.topk(pending, corpus, m, spec, block_rows)
        got = materialise(_cap(wide, k, cap, group, spec).drop("rank"))
        if m >= rows - 1:                         # all rows were fetched
            return S.rank_final(S.union_all([*done, got]), k, spec).select("query_id", "rank", *got.columns[1:])
        full = got.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
        done.append(got.join(full, "query_id", "left_semi"))
        pending = materialise(pending.join(full.withColumnRenamed("query_id", spec.id_col), spec.id_col, "left_anti"))
        m *= GROW
    rest = _per_group(pending, corpus, k, cap, group, spec, block_rows)
    if rest is not None:
        done.append(S.with_columns(rest, corpus, spec).drop("rank"))
    out = S.union_all(done)
    return S.rank_final(out, k, spec).select("query_id", "rank", *out.columns[1:])


def mmr(queries: DataFrame, corpus: DataFrame, k: int, balance: float = 0.7, pool: int = 50,
        spec: RankSpec = PRODUCT_RANK, block_rows: int = S.BLOCK_ROWS) -> DataFrame:
    """Maximal marginal relevance: (query_id, rank, id, score, mmr, first_rank, carried columns).

    A query's candidates are its exact top ``pool``; their lists meet in one group of at most ``pool`` rows.
    """
    if not 0 <= balance <= 1:
        raise ValueError("the balance lies between 0 and 1")
    pool = max(k, pool)
    id_type = spec.id_type
    schema = f"query_id {id_type}, rank long, {spec.id_col} {id_type}, score double, mmr double, first_rank long"
    if k <= 0:
        base = S.no_result(corpus, spec).withColumns({"mmr": F.lit(0.0), "first_rank": F.col("rank")})
        return base.select("query_id", "rank", spec.id_col, "score", "mmr", "first_rank", *base.columns[4:-2])
    top = S.topk(queries, corpus, pool, replace(spec, carry=()), block_rows)
    top = top.select("query_id", F.col("rank").alias("first_rank"), spec.id_col, "score")
    lists = S.query_side(corpus, spec)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first_rank", ignore_index=True)
        x = S._dense(pdf, S._vocab(pdf, spec=spec), spec)
        like = np.round(x @ x.T, spec.score_places)
        score = pdf["score"].to_numpy()
        near = np.full(len(pdf), -np.inf)          # similarity to the nearest chosen row
        left, picked, worth = np.ones(len(pdf), bool), [], []
        for _ in range(min(k, len(pdf))):
            lost = np.where(np.isinf(near), 0.0, near)
            value = np.where(left, np.round(balance * score - (1 - balance) * lost, spec.score_places), -np.inf)
            i = int(np.argmax(value))              # the first of equal values: the better original rank
            picked.append(i)
            worth.append(value[i])
            left[i] = False
            near = np.maximum(near, like[i])
        out = pdf.iloc[picked]
        return pd.DataFrame({"query_id": out["query_id"], "rank": np.arange(1, len(out) + 1),
                             spec.id_col: out[spec.id_col], "score": out["score"], "mmr": worth,
                             "first_rank": out["first_rank"]})

    chosen = top.join(lists, spec.id_col).groupBy("query_id").applyInPandas(choose, schema)
    show = list(dict.fromkeys([c for c in spec.carry if c != spec.id_col] + [c for c, _, _ in spec.tiebreak]))
    own = corpus.select(F.col(spec.id_col).alias(spec.id_col), *[F.col(c).alias(c) for c in show])
    return chosen.join(own, spec.id_col).select("query_id", "rank", spec.id_col, "score", "mmr", "first_rank", *show)
