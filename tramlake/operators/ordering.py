"""Row numbers, latest and first rows, count windows and positional joins over time-ordered tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tramlake.functions.time import moment


def newest(df: DataFrame, time: str, n: int | None = 1, ordered: bool = True) -> DataFrame:
    """The n rows of the greatest times, newest first (all rows for None, in any order if not `ordered`)."""
    if n is None and not ordered:
        return df
    out = df.orderBy(F.col(time).desc())
    return out if n is None else out.limit(n)


def oldest(df: DataFrame, time: str, n: int | None = 1, ordered: bool = True) -> DataFrame:
    """The n rows of the least times, oldest first (all rows for None, in any order if not `ordered`)."""
    if n is None and not ordered:
        return df
    out = df.orderBy(F.col(time).asc())
    return out if n is None else out.limit(n)


def after(df: DataFrame, time: str, start, n: int | None = None, ordered: bool = True) -> DataFrame:
    """The n newest of the rows strictly after `start`: the newest, not the next."""
    return newest(df.where(F.col(time) > moment(start)), time, n, ordered)


def before(df: DataFrame, time: str, end, n: int | None = None, ordered: bool = True) -> DataFrame:
    """The n newest of the rows strictly before `end`."""
    return newest(df.where(F.col(time) < moment(end)), time, n, ordered)


def between(df: DataFrame, time: str, start=None, end=None, n: int | None = None, ordered: bool = True) -> DataFrame:
    """The n oldest rows of the open interval; a bound of None is no bound."""
    if start is not None:
        df = df.where(F.col(time) > moment(start))
    if end is not None:
        df = df.where(F.col(time) < moment(end))
    return oldest(df, time, n, ordered)


def within(df: DataFrame, time: str, start, end) -> DataFrame:
    """The rows of the closed interval."""
    return df.where(F.col(time).between(moment(start), moment(end)))


def numbered(df: DataFrame, order: Sequence[str], bucket: Column, name: str = "n") -> DataFrame:
    """Adds the 1-based position of each row in the order of the columns `order`.

    `bucket` must not decrease along that order. Rows are ranked inside their bucket and moved up by the sizes of the
    buckets before; only the table of bucket sizes is ordered as a whole, so the number of tasks grows with the buckets.
    Nulls come first and are a bucket like any other; rows that are equal in `order` are numbered in any order.
    """
    marked = df.withColumn("__bucket", bucket)
    sizes = marked.groupBy("__bucket").agg(F.count("*").alias("__size"))
    offset = F.sum("__size").over(W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")
    offsets = sizes.select("__bucket", offset.alias("__offset"))
    rank = F.row_number().over(W.partitionBy("__bucket").orderBy(*order))
    ranked = marked.withColumn("__rank", rank)
    moved = ranked.join(offsets.withColumnRenamed("__bucket", "__of"), F.col("__bucket").eqNullSafe(F.col("__of")))
    return moved.withColumn(name, F.col("__rank") + F.col("__offset")).drop("__bucket", "__of", "__rank", "__offset")


def count_windows(df: DataFrame, time: str, bucket: Column, n: int, strict: bool = True) -> DataFrame:
    """Tumbling windows of n distinct times: adds `window` (from 0) and `place` (1 to n) to every row.

    A strict source leaves out the last window until it is complete, a lenient one keeps it.
    """
    times = numbered(df.select(time).distinct(), [time], bucket, "__at")
    times = times.withColumn("window", F.floor((F.col("__at") - 1) / n)).withColumn("place", (F.col("__at") - 1) % n + 1).drop("__at")
    if strict:
        full = times.groupBy("window").agg(F.count("*").alias("__full")).where(F.col("__full") == n).select("window")
        times = times.join(full, "window", "left_semi")
    return df.join(times, time)


def zipped(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], left_bucket: Column, right_bucket: Column) -> DataFrame:
    """Joins the rows of two ordered tables by position, as far as the shorter goes."""
    return numbered(left, left_order, left_bucket, "position").join(numbered(right, right_order, right_bucket, "position"), "position")


def first_of_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row a key, the first in the order."""
    return df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key no other row has: every row of a repeated key goes.

    Rows are counted before the shuffle, with one of them kept, so a key with very many rows is a row a task.
    """
    others = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.count("*").alias("__rows"), F.first(F.struct(F.lit(0).alias("__"), *others)).alias("__row")).where("__rows = 1")
    return kept.select(*(c if c in keys else F.col(f"__row.{c}") for c in df.columns))


def several(df: DataFrame, keys: Sequence[str], least: int = 2) -> DataFrame:
    """The rows whose key has at least so many rows; null keys are one key. A key with very many rows is split by the skew join."""
    counted = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.count("*").alias("__rows")).where(F.col("__rows") >= least)
    return df.join(counted, same(keys), "left_semi")


def same(keys: Sequence[str], prefix: str = "__") -> Column:
    """Null-safe equality of columns and their namesakes with a prefix."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out
