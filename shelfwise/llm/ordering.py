"""Global ranks and running totals without a window over the whole table.

Rows are dealt by ranges of the sort key (Spark samples the ranges), numbered or summed inside each range,
and shifted by what the ranges before hold: one row per range, so that part stays as small as the number
of shuffle partitions however large the table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize


def _ranges(df: DataFrame) -> int:
    """Ranges to deal to: shuffle partitions, as the session has them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _shifted(parts: DataFrame, value: str) -> DataFrame:
    """Per range: the total of the ranges before it. `parts` has one row per range."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_range", F.coalesce(F.sum(value).over(before), F.lit(0).cast("bigint")).alias("_shift"))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with `name`: the position of each row in `order`, from 0. Rows equal in `order` rank in any order."""
    row = F.monotonically_increasing_id()  # range number, then position in the range
    dealt = df.repartitionByRange(_ranges(df), *order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("_row", row), "ranked")
    dealt = dealt.withColumn("_range", F.shiftright("_row", 33)).withColumn("_row", F.col("_row").bitwiseAND((1 << 33) - 1))
    parts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    joined = dealt.join(F.broadcast(_shifted(parts, "n")), "_range")  # one row per shuffle partition
    return joined.withColumn(name, F.col("_shift") + F.col("_row")).drop("_range", "_row", "_shift")


def running_total(df: DataFrame, order: list[Column], value: str, name: str = "before") -> DataFrame:
    """df with `name`: the sum of `value` over the rows before it in `order` (a total order)."""
    dealt = df.repartitionByRange(_ranges(df), *order).withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt, "running")
    parts = dealt.groupBy("_range").agg(F.sum(value).alias("n"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0).cast("bigint")))
    joined = local.join(F.broadcast(_shifted(parts, "n")), "_range")  # one row per shuffle partition
    return joined.withColumn(name, F.col(name) + F.col("_shift")).drop("_range", "_shift")
