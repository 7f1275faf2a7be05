"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; Catalyst prunes columns and pushes filters into the scan.

    ``spread=True`` is for tables with heavy per-row work (regexes over text):
    when the scan yields fewer splits than there are cores (one small file),
    rows are dealt round-robin over the cores.  A large input already has many
    splits, and then nothing is added.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread:
        from simcat.session import spread as _spread
        df = _spread(df)
    return df
