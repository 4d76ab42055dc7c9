"""Quantiles of whole numbers from counts by bucket, which merge in any order.

Buckets are exact up to 2^(BITS+1) and then 2^BITS a doubling, so a bucket's numbers differ by less than one part in 2^BITS. A sketch is a row per group and bucket; two
sketches merge by adding their counts, which gives the same sketch in whatever order, and a group has 2^BITS * 62 buckets at most, however many rows.
The number returned for a quantile is the least of the bucket that has the row of that rank: it is at most the exact quantile, and less by under one part in 2^BITS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 5


def _length(x: Column) -> Column:
    return F.length(F.bin(x))


def _shifted(way: str, x: Column, by: Column) -> Column:
    return F.call_function(f"shift{way}", x, by)


def bucket(x: Column, bits: int = BITS) -> Column:
    """The bucket of a whole number from 0; buckets are in the order of their numbers."""
    shift = F.greatest(F.lit(0), _length(x) - (bits + 1)).cast("int")
    return (_shifted("right", x, shift) + F.shiftleft(shift.cast("long"), bits)).cast("long")


def least(b: Column, bits: int = BITS) -> Column:
    """The least number of a bucket."""
    shift = F.greatest(F.lit(0), F.shiftright(b, bits) - 1).cast("int")
    return _shifted("left", b - F.shiftleft(shift.cast("long"), bits), shift)


def sketch(df: DataFrame, value: str, *groups: str, bits: int = BITS) -> DataFrame:
    """groups, bucket, n. Null values are left out; negative ones are an error."""
    x = F.col(value).cast("long")
    checked = F.when(x < 0, F.raise_error(F.lit(f"negative {value}"))).otherwise(bucket(x, bits))
    return df.where(x.isNotNull()).groupBy(*groups, checked.alias("bucket")).agg(F.count("*").alias("n"))


def merge(one: DataFrame, *more: DataFrame) -> DataFrame:
    """Sketches of the same groups as one."""
    for other in more:
        one = one.unionByName(other)
    groups = [c for c in one.columns if c not in ("bucket", "n")]
    return one.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, *per_mille: int, bits: int = BITS) -> DataFrame:
    """groups, n and a column p<q> for each q, in thousandths: about the value of rank ceil(n * q / 1000)."""
    groups = [c for c in sketches.columns if c not in ("bucket", "n")]
    upto = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketches.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*groups)))
    at = lambda q: least(F.min(F.when(F.col("upto") * 1000 >= F.col("total") * q, F.col("bucket"))), bits).alias(f"p{q}")
    return ranked.groupBy(*groups).agg(F.max("total").alias("n"), *map(at, per_mille))
