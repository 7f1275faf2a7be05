"""Line-delimited JSON scan that survives malformed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simcat.functions.parsers import strip

CORRUPT = "_corrupt_record"


def scan_ldjson(spark: SparkSession, path: str, columns: list[str],
                keep_corrupt: bool = False) -> DataFrame:
    """Read a ``.ldjson`` file (or folder) as all-string columns.

    Lines are trimmed, blank lines skipped; a line that is not a JSON object is
    routed to ``_corrupt_record`` (good rows have it null).  ``src_seq`` is the
    position of the record: file name order, then the line's place in its
    split, so keep-first rules can use it.  With ``keep_corrupt=False`` bad
    lines are dropped.

    Raises FileNotFoundError if nothing exists at ``path`` and ValueError if
    no line parses.
    """
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        raise FileNotFoundError(f"no records at {path}: it does not exist")

    out = parse_lines(spark.read.text(path), columns)
    if out.where(F.col(CORRUPT).isNull()).limit(1).count() == 0:
        raise ValueError(f"{path} holds no line that is a JSON object")
    return out if keep_corrupt else out.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def parse_lines(text: DataFrame, columns: list[str]) -> DataFrame:
    """``value`` lines -> all-string columns, ``_corrupt_record``, ``src_seq``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField(CORRUPT, T.StringType())])
    # File order without a global sort: (file, split start, position in the
    # task) orders every line, and is comparable as one struct column.
    lines = (text
             .select(strip(F.col("value")).alias("line"),
                     F.struct(F.col("_metadata.file_path").alias("file"),
                              F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("pos")).alias("src_seq"))
             .where(F.col("line") != ""))
    parsed = lines.select(
        F.from_json("line", schema, {"mode": "PERMISSIVE",
                                     "columnNameOfCorruptRecord": CORRUPT}).alias("r"),
        "line", "src_seq")
    # from_json gives a null struct for non-object JSON such as `[1]`.
    out = parsed.select(
        *[F.col(f"r.{c}").alias(c) for c in columns],
        F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), F.col("line"))
         .alias(CORRUPT),
        "src_seq")
    return out


def parse_records(df: DataFrame, text_col: str, columns: list[str]) -> DataFrame:
    """JSON-object text in any column -> all-string fields plus ``_corrupt_record``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField(CORRUPT, T.StringType())])
    r = F.from_json(strip(F.col(text_col)), schema,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.withColumn("_r", r).select(
        "*", *[F.col(f"_r.{c}").alias(c) for c in columns],
        F.when(F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull(), F.col(text_col))
         .alias(CORRUPT)).drop("_r")


def malformed_count(df_with_corrupt: DataFrame) -> DataFrame:
    """One row: good and skipped (malformed) line counts."""
    return df_with_corrupt.agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("good_lines"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("skipped_lines"))
