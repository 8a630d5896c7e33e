"""Running counts over long keyed sequences without holding a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 4096


def running_sum(df: DataFrame, keys: list[str], position: str, value: Column, out: str, chunk: int = CHUNK) -> DataFrame:
    """Adds the sum of ``value`` up to and including each row, by key in order of an integer
    position. Sums run within bounded chunks of positions; a window over chunk totals carries
    them across. Keys must not be null."""
    rows = df.withColumn("_chunk", F.floor(F.col(position) / F.lit(chunk))).withColumn("_value", value.cast("bigint"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(position)
    rows = rows.withColumn("_within", F.sum("_value").over(within))
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    return rows.join(totals, [*keys, "_chunk"]).withColumn(out, F.col("_within") + F.col("_before")).drop("_chunk", "_value", "_within", "_before")
