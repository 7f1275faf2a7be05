"""Helpers shared by the training-data operators: table reads, shared storage, batches."""

from __future__ import annotations

import contextlib
import math
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = str.maketrans(ASCII_UPPER, ASCII_LOWER)

# Rows handed to Python at once.  Texts may be long, so batches stay small.
BATCH_ROWS = 256
# Texts for each task that writes an intermediate table, where their number is known.
TASK_ROWS = 8192


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch, so a worker never holds thousands of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session (tests) may go without the setting; it gets a folder of its own.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="simcat-llm-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that write a table about ``rows`` texts: one for ``TASK_ROWS`` of them, and one for each core."""
    return max(1, spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def materialise(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back.

    No more than ``tasks`` tasks write, if given.  On a local disk Hadoop starts three processes (chmod) for each
    file, and each shares the executor's memory while it starts: many small files cost time, and count twice.
    """
    path = shared_path(df.sparkSession, label)
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def measured_joins(spark: SparkSession):
    """While it lasts, a joined table is broadcast only once adaptive execution has measured that it is small.

    Before it runs, Spark takes a written table for as large as its files, whatever they unpack to, and an exploded
    array for one row.  What is returned unplanned needs a hint instead.
    """
    static, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {c: spark.conf.get(c, None) for c in (static, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(static))
    spark.conf.set(static, "-1")
    try:
        yield
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def lower_ascii(col):
    """Lower-case A-Z only."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def crc_mod(col, m: int):
    """crc32 of the id written as text, modulo ``m`` (null ids count as an empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


HOT_SHARE = 1000  # a key with more than 1/HOT_SHARE of the rows is hot: there are < HOT_SHARE of them


def hot_join(rows: DataFrame, groups: DataFrame, key: list[str], total: int,
             size: str = "group_size", hint: str | None = None) -> DataFrame:
    """Inner join of ``rows`` with one row per key (``groups``, which has the key's row count).

    Fewer than ``HOT_SHARE`` keys can hold more than 1/HOT_SHARE of ``total`` rows each; those are
    broadcast, so no task gets a hot key.  All other keys are joined by an exchange (by ``hint``, if given).
    """
    limit = max(2, total // HOT_SHARE)
    hot = groups.filter(F.col(size) > limit)
    value = [c for c in groups.columns if c not in key]
    with_hot = rows.join(F.broadcast(hot), key, "left")
    done = with_hot.filter(F.col(size).isNotNull())
    rest = with_hot.filter(F.col(size).isNull()).drop(*value)
    others = groups.filter(F.col(size) <= limit)
    return done.unionByName(rest.join(others.hint(hint) if hint else others, key))
