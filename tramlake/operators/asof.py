"""As-of joins: for each left row, what the right table had last before its time.

Both sides are cut into time buckets. Inside a (key, bucket) a window carries the last right row forward; what came last in
earlier buckets is taken from a summary of one row a (key, bucket). So one key with very many rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str], bucket: str = "day") -> DataFrame:
    """Left rows with the columns `values` of the last right row strictly before (null if there is none).

    Right rows of equal key and time are told apart by their values, the greatest counts as last.
    """
    cell = F.struct(F.col(right_time).alias("t"), *(F.col(v).alias(f"v{k}") for k, v in enumerate(values)))
    cut = lambda time: F.date_trunc(bucket, F.col(time))
    own = right.select(*keys, cut(right_time).alias("__bucket"), F.col(right_time).alias("__t"), cell.alias("__cell"))
    last = own.groupBy(*keys, "__bucket").agg(F.max("__cell").alias("__last"))
    # The last right row of all earlier buckets, wanted in every bucket that has left rows.
    wanted = left.select(*keys, cut(left_time).alias("__bucket")).distinct().withColumn("__wanted", F.lit(True))
    cells = last.join(wanted, [*keys, "__bucket"], "full")
    earlier = F.last("__last", ignorenulls=True).over(W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1))
    carried = cells.withColumn("__carried", earlier).where("__wanted").select(*keys, "__bucket", "__carried")
    # Left rows come before right rows of the same time, so that only strictly earlier ones are carried to them.
    rows = left.select(*keys, cut(left_time).alias("__bucket"), F.col(left_time).alias("__t"), F.lit(0).alias("__side"), F.struct(*left.columns).alias("__row"))
    both = rows.unionByName(own.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    order = W.partitionBy(*keys, "__bucket").orderBy("__t", "__side", "__cell").rowsBetween(W.unboundedPreceding, 0)
    seen = both.withColumn("__seen", F.last("__cell", ignorenulls=True).over(order)).where("__side = 0")
    out = seen.join(carried, [*keys, "__bucket"], "left").withColumn("__found", F.coalesce("__seen", "__carried"))
    return out.select("__row.*", *(F.col(f"__found.v{k}").alias(v) for k, v in enumerate(values)))


def asof_last_n(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str], n: int, bucket: str = "day") -> DataFrame:
    """Left rows, each with up to n rows of the right table strictly before it, `age` 1 being the last; left rows without any
    are left out. Right rows are numbered by time and values within their key, inside buckets and on top of the buckets
    before, and found again by that number."""
    cut = lambda time: F.date_trunc(bucket, F.col(time)).alias("__bucket")
    own = right.select(*keys, cut(right_time), F.col(right_time).alias("__t"), *values)
    marks = left.select(*keys, cut(left_time), F.col(left_time).alias("__t"), F.lit(0).alias("__side"), F.struct(*left.columns).alias("__row"))
    sizes = own.select(*keys, "__bucket", F.lit(1).alias("__one")).union(marks.select(*keys, "__bucket", F.lit(0))).groupBy(*keys, "__bucket").agg(F.sum("__one").alias("__size"))
    offset = F.sum("__size").over(W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")
    offsets = sizes.select(*keys, "__bucket", offset.alias("__offset"))
    rank = F.row_number().over(W.partitionBy(*keys, "__bucket").orderBy("__t", *values))
    numbered = own.withColumn("__rank", rank).join(offsets, [*keys, "__bucket"]).select(*keys, (F.col("__rank") + F.col("__offset")).alias("__n"), *values)
    both = marks.unionByName(own.select(*keys, "__bucket", "__t", F.lit(1).alias("__side")), allowMissingColumns=True)
    inside = F.sum("__side").over(W.partitionBy(*keys, "__bucket").orderBy("__t", "__side").rowsBetween(W.unboundedPreceding, 0))
    seen = both.withColumn("__inside", inside).where("__side = 0").join(offsets, [*keys, "__bucket"]).withColumn("__upto", F.col("__inside") + F.col("__offset")).where("__upto > 0")
    ages = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(n).cast("long"), F.col("__upto")))).alias("age")
    wanted = seen.select(*keys, "__row", "__upto", ages).withColumn("__n", F.col("__upto") - F.col("age") + 1)
    return wanted.join(numbered, [*keys, "__n"]).select("__row.*", "age", *values)


def asof_or_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, value: str, bucket: str = "day") -> DataFrame:
    """As asof(), but where nothing came before, the latest row of the whole right table, which may lie in the future."""
    latest = right.select(F.max_by(value, right_time))
    return asof(left, right, keys, left_time, right_time, [value], bucket).withColumn(value, F.coalesce(F.col(value), latest.scalar()))
