"""Incremental ingest: new ``.ldjson`` files in a folder -> cleaned product rows.

A Structured Streaming query over the file source.  Each micro-batch parses its lines with the
batch parser, keeps the first row per id in file order, drops ids that the product table already
holds (an anti-join against the table, so no state grows with the number of ids ever seen) and
appends the rest.  A batch that is run again after a failure finds the rows it had written and
adds none twice.  Malformed lines are left out.  Progress lives in the checkpoint location.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from simcat.operators import normalise as N
from simcat.sources.catalog import RAW_COLUMNS
from simcat.sources.ldjson import CORRUPT, parse_lines

DUMP_COLUMNS = [c for c in RAW_COLUMNS if c != "src_seq"]


def ingest_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                  checkpoint: str | None = None, available_now: bool = False,
                  columns: list[str] | None = None) -> StreamingQuery:
    """Start the ingest query; returns the running StreamingQuery."""
    if checkpoint is None:
        from simcat.session import ensure_checkpoint_dir
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "ingest-" + os.path.basename(
            sink_dir.rstrip("/")))
    def append(batch, _):
        session = batch.sparkSession
        raw = parse_lines(batch, columns or DUMP_COLUMNS).where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        products = N.normalise(raw, keep_seq=False)
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(sink_dir)
        fs = path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            known = session.read.schema(products.schema).parquet(sink_dir).select("product_id")
            products = products.join(known, "product_id", "left_anti").select(*N.PRODUCT_COLUMNS)
        products.write.mode("append").parquet(sink_dir)

    writer = (spark.readStream.text(source_dir).select("value", "_metadata").writeStream
              .foreachBatch(append).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
