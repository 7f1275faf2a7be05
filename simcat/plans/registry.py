"""Query registry: key -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None          # None -> rows-only check plus own tests
    headline: bool = False   # part of bench.py


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | Callable[[], str] | None = None, headline: bool = False):
    def deco(fn):
        text = sql() if callable(sql) else sql
        QUERIES[name] = Query(name, fn, text, headline)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills QUERIES
    from simcat.plans import (q_scalar, q_clean, q_profile, q_features,  # noqa: F401
                              q_text, q_search, q_request, q_neighbours)
    return QUERIES
