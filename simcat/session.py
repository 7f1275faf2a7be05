"""Session helpers: defaults for local runs and a shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "simcat") -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SIMCAT_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder set by ``spark.checkpoint.dir``.

    Only a local session, whose tasks all run on this machine, may go without it and gets a folder
    of its own; on a cluster a machine-local folder would be lost to the other nodes.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        configured = tempfile.mkdtemp(prefix="simcat-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    A reliable checkpoint survives the loss of the executors that computed it,
    unlike a cache or a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


PACK_ROWS = 1 << 17      # rows of a compressed batch


def packed(df: DataFrame) -> DataFrame:
    """``materialise`` as compressed batches of columns, for tables of many short rows.

    A checkpoint holds every row on its own, uncompressed.  The partitions are those of ``df``, but Spark no
    longer knows by which key.
    """
    def pack(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK_ROWS:
                yield _blob(held)
                held, n = [], 0
        if n:
            yield _blob(held)

    blobs = materialise(df.mapInArrow(pack, "blob binary"))
    rows = blobs.mapInArrow(_unpacked(df.columns), df.schema)
    rows._blobs = blobs
    return rows


def _unpacked(columns: list[str], fn=None):
    def rows(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            for blob in batch.column(0):
                yield from pq.read_table(pa.BufferReader(blob.as_buffer()), columns=columns).to_batches()
    return rows if fn is None else lambda batches: fn(rows(batches))


def map_columns(df: DataFrame, columns: list[str], fn, schema) -> DataFrame:
    """``fn`` of Arrow batches of some columns; a ``packed`` table's are unpacked in the same worker, not as rows first."""
    blobs = df.__dict__.get("_blobs")
    return (df.select(*columns).mapInArrow(fn, schema) if blobs is None
            else blobs.mapInArrow(_unpacked(columns, fn), schema))


def _blob(batches):
    import pyarrow as pa
    import pyarrow.parquet as pq
    rows, out = pa.Table.from_batches(batches), pa.BufferOutputStream()
    texts = [f.name for f in rows.schema if pa.types.is_string(f.type)]
    pq.write_table(rows, out, compression="zstd", compression_level=4,
                   use_dictionary=[c for c in rows.column_names if c not in texts],
                   column_encoding={c: "DELTA_LENGTH_BYTE_ARRAY" for c in texts})
    return pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["blob"])


def drop(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``tables``; nothing may read them any more."""
    for df in tables:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free(spark: SparkSession) -> None:
    """Let go of the shuffle files that no table needs any more.

    Spark deletes them when the driver's garbage is collected, which may be long after many of them were written.
    """
    gc.collect()
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round-robin over the cores when ``df`` has fewer partitions than cores.

    For small inputs (one file, or a table that adaptive execution coalesced)
    ahead of CPU-heavy per-row work.  Large inputs already have many partitions
    and are returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
