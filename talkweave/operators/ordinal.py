"""Row numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.storage import stored


def ordinal(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """Adds a number from 0 in the given order. Rows are range-partitioned and numbered in their partition; the partitions'
    sizes, one row each, give the offsets. The order must tell all rows apart, so that a task that runs again numbers alike.
    Rows are written with their partition once: evaluated again for the sizes, other bounds could hold."""
    part = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = part.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part").orderBy(*order)
    return part.join(F.broadcast(offsets), "__part").withColumn(name, F.row_number().over(inside) - 1 + F.col("__offset")).drop("__part", "__offset")


def ordinal_within(df: DataFrame, group: str, *order: str, name: str = "idx") -> DataFrame:
    """Numbers from 0 within each group, null being one; a large group is spread like a whole table. Groups are few."""
    all_ = ordinal(df, group, *order, name="__all")
    first = all_.groupBy(F.col(group).alias("__group")).agg(F.min("__all").alias("__first"))
    return all_.join(first, F.col(group).eqNullSafe(F.col("__group"))).withColumn(name, F.col("__all") - F.col("__first")).drop("__all", "__group", "__first")
