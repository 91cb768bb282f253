"""Aggregates and window statistics of trajectories and measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tramlake.functions.numbers import rounded
from tramlake.operators.ordering import same


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of a column a key; rows with a null key are left out."""
    return df.dropna(subset=[*keys]).groupBy(*keys).agg(F.avg(value).alias(name))


def pair_speed(df: DataFrame, keys: Sequence[str], place: str, distance: str, seconds: Column) -> DataFrame:
    """km/h between the first and second row of each window: keys repeated in a pair go, and so does what did not move forward.

    Null keys match each other.
    """
    now, then = df.where(F.col(place) == 2).alias("now"), df.where(F.col(place) == 1).alias("then")
    same = F.col("now.window") == F.col("then.window")
    for k in keys:
        same = same & F.col(f"now.{k}").eqNullSafe(F.col(f"then.{k}"))
    joined = now.join(then, same).select("now.window", *(F.col(f"now.{k}") for k in keys), F.col(f"now.{distance}").alias("d2"), F.col(f"then.{distance}").alias("d1"), seconds.alias("seconds"))
    alone = joined.withColumn("__rows", F.count("*").over(W.partitionBy("window", *keys))).where("__rows = 1 AND d1 < d2")
    return alone.select("window", *keys, rounded((F.col("d2") - F.col("d1")) / F.col("seconds") * 3.6, 2).alias("speed"))


def deltas(df: DataFrame, key: str, time: str, value: str, bucket: str = "day") -> DataFrame:
    """Change of a value from the row before, in the order of time (equal times by value), null for a key's first row and where either is null.

    A key's rows are ordered inside time buckets; what the first row of a bucket follows comes from a table of a row a (key, bucket).
    """
    cell = F.struct(F.lit(True).alias("there"), F.col(value).alias("v"))
    marked = df.withColumn("__bucket", F.date_trunc(bucket, F.col(time)))
    order = F.struct(time, value)
    ends = marked.groupBy(F.col(key).alias("__k"), F.col("__bucket").alias("__b")).agg(F.max_by(cell, order).alias("__last"))
    carried = ends.withColumn("__before", F.lag("__last").over(W.partitionBy("__k").orderBy("__b"))).drop("__last")
    near = F.lag(cell).over(W.partitionBy(key, "__bucket").orderBy(time, value))
    rows = marked.withColumn("__near", near).join(carried, F.col(key).eqNullSafe(F.col("__k")) & F.col("__bucket").eqNullSafe(F.col("__b")), "left")
    before = F.when(F.col("__near.there"), F.col("__near.v")).otherwise(F.col("__before.v"))
    return rows.withColumn("delta", F.col(value) - before).select(*df.columns, "delta")


def normalised(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """0 to 1 between a key's least and greatest value; 0 where they are the same."""
    ends = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(value).alias("__least"), F.max(value).alias("__most"))
    share = F.when(F.col("__most") == F.col("__least"), F.lit(0.0)).otherwise((F.col(value) - F.col("__least")) / (F.col("__most") - F.col("__least")))
    return df.join(ends, same(keys)).withColumn(name, share).select(*df.columns, name)


def z_outliers(df: DataFrame, keys: Sequence[str], value: str, limit: float) -> DataFrame:
    """Rows further from their key's mean than `limit` population standard deviations, with their z; null keys are one key."""
    stats = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__std"))
    z = (F.col(value) - F.col("__mean")) / F.col("__std")
    return df.join(stats, same(keys)).where("__std > 0").withColumn("z", z).where(F.abs("z") > limit).select(*df.columns, "z")


def ols(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Slope and intercept of a value over the seconds since its key's first time."""
    first = df.groupBy(key).agg(F.min(time).alias("__first"))
    x = F.timestamp_diff("MICROSECOND", F.col("__first"), F.col(time)) / 1e6
    return df.join(first, key).groupBy(key).agg(F.regr_slope(F.col(value), x).alias("slope"), F.regr_intercept(F.col(value), x).alias("intercept"))
