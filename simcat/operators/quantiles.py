"""Exact quantiles per key, entirely in Spark.

Distinct values of a key are counted first (partial aggregation, so repeated values shrink before
any exchange) and sorted over range partitions by (key, value).  The number of values before each
partition gives every row its place in its key, and only the partitions that hold a wanted place
are ranked.  A key may span any number of partitions, so neither a large group nor a hot key ever
meets in one task, and no value goes through the driver.

Quantiles use linear interpolation between the two neighbouring order statistics (numpy/pandas
``linear``; the median of an even count is the mean of the middle two).  Missing values (null, NaN)
don't count; a null key is a key of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quantiles(values: DataFrame, key: str, value: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles per key: columns (key, p, q)."""
    from simcat.session import materialise
    counted = (values.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v"))
               .where(F.col("v").isNotNull() & ~F.isnan("v"))
               .groupBy("k", "v").agg(F.count("*").alias("n")))
    # written once: the partition number is part of a row's place
    placed = materialise(counted.repartitionByRange("k", "v")
                         .withColumn("pid", F.spark_partition_id()))
    # one row per key and partition
    parts = placed.groupBy("k", "pid").agg(F.sum("n").alias("m"))
    whole = Window.partitionBy("k")
    parts = parts.select(
        "k", "pid", "m", F.sum("m").over(whole).alias("total"),
        F.coalesce(F.sum("m").over(whole.orderBy("pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # wanted places, each in the partition that holds it
    pos = F.col("p") * (F.col("total") - 1)
    wanted = (parts.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
              .withColumn("s", F.explode(F.array(
                  F.struct(F.lit("a").alias("side"), F.floor(pos).alias("rank")),
                  F.struct(F.lit("b").alias("side"), F.ceil(pos).alias("rank")))))
              .select("k", "pid", "p", (pos - F.floor(pos)).alias("frac"), "before",
                      "s.side", "s.rank")
              .join(parts.select(F.col("k").alias("k2"), F.col("pid").alias("pid2"), "m"),
                    F.col("k").eqNullSafe(F.col("k2")) & (F.col("pid") == F.col("pid2")))
              .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("m")))
              .groupBy("k", "pid").agg(
                  F.first("before").alias("before"),
                  F.collect_list(F.struct("p", "frac", "side", "rank")).alias("want")))
    w = wanted.select(F.col("k").alias("wk"), F.col("pid").alias("wpid"), "before", "want")
    rows = placed.join(w, F.col("k").eqNullSafe(F.col("wk")) & (F.col("pid") == F.col("wpid")))
    last = F.col("before") + F.sum("n").over(
        Window.partitionBy("k", "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    hits = (rows.withColumn("last", last)
            .withColumn("t", F.explode(F.filter("want", lambda t: (t["rank"] < F.col("last"))
                                                & (t["rank"] >= F.col("last") - F.col("n")))))
            .select("k", "t.*", "v"))
    side = lambda x: F.max(F.when(F.col("side") == x, F.col("v")))
    out = hits.groupBy("k", "p", "frac").agg(side("a").alias("a"), side("b").alias("b"))
    return out.select(F.col("k").alias(key), "p",
                      (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("q"))
