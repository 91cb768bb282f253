"""Joins beyond plain equality: first match, successors, unique fallbacks, copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window as W, functions as F


def first_other(left: DataFrame, right: DataFrame, keys: dict[str, str], other: tuple[str, str], order: Sequence[str]) -> DataFrame:
    """Left rows, each with the first right row (by `order`, then its other columns) of the same keys whose other[1] is not the left other[0].

    keys: left column to right column. A left row without such a row, or with a null other[0], has nulls. Of each key the first right row, and the first
    whose value is another, are found by combining aggregates: no pairs are made, and a left row is joined to one row.
    """
    columns = [c for c in right.columns if c not in order]
    row = F.struct(*order, *columns)
    value = f"first.{other[1]}"
    own = [F.col(c).alias(f"__{c}") for c in keys.values()]
    firsts = right.where(F.col(other[1]).isNotNull()).groupBy(*own, F.col(other[1]).alias("__value")).agg(F.min(row).alias("first"))
    best = firsts.groupBy(*(f"__{c}" for c in keys.values())).agg(F.min("first").alias("first"))
    names = [f"__{c}" for c in keys.values()]
    second = firsts.withColumnRenamed("first", "next").join(best, names).where(F.col("__value") != F.col(value)).groupBy(*names).agg(F.min("next").alias("second"))
    two = best.join(second, names, "left")
    on = reduce(and_, (F.col(a) == F.col(f"__{b}") for a, b in keys.items()))
    mine = F.col(other[0])
    found = F.when(mine.isNotNull(), F.when(F.col(value) != mine, F.col("first")).otherwise(F.col("second")))
    return left.join(two, on, "left").withColumn("__found", found).select(*left.columns, *(F.col(f"__found.{c}").alias(c) for c in right.columns))


def with_successor(df: DataFrame, key: str, sequence: str, columns: Sequence[str], suffix: str = "_next") -> DataFrame:
    """Rows joined to the row of the same key whose sequence number is one higher; a gap in the numbers is no succession."""
    after = df.select(F.col(key), (F.col(sequence) - 1).alias(sequence), *(F.col(c).alias(c + suffix) for c in columns))
    return df.join(after, [key, sequence])


def match_or_fall_back(rows: DataFrame, exact: DataFrame, loose: DataFrame, id_: str, exact_on: Sequence[str], loose_on: Sequence[str], value: str) -> DataFrame:
    """Matches on all keys with confidence 5; of the others, those with one loose match alone, with confidence 4."""
    sure = rows.join(exact, [*exact_on], "left")
    found = sure.where(F.col(value).isNotNull()).select(id_, value, F.lit(5).alias("confidence"))
    rest = sure.where(F.col(value).isNull()).select(*rows.columns)
    maybe = rest.join(loose, [*loose_on]).withColumn("__matches", F.count("*").over(W.partitionBy(id_)))
    return found.unionByName(maybe.where("__matches = 1").select(id_, value, F.lit(4).alias("confidence")))


def point_to_copies(df: DataFrame, id_: str, payload: str) -> DataFrame:
    """Replaces a payload seen under a smaller id by a pointer to it: columns hash, copy_id (null for the first) and the payload (null for copies).
    Rows without a payload stay as they are, without hash and copy_id.

    The smallest id of each hash is found by a combining aggregate, and only hashes that several rows have are joined back.
    """
    hashed = df.withColumn("hash", F.md5(F.col(payload).cast("binary")))
    first = hashed.where("hash IS NOT NULL").groupBy(F.col("hash").alias("__hash")).agg(F.min(id_).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    copy = F.coalesce(F.col(id_) != F.col("__first"), F.lit(False))
    out = hashed.join(first, F.col("hash") == F.col("__hash"), "left").withColumn("copy_id", F.when(copy, F.col("__first")))
    return out.withColumn(payload, F.when(~copy, F.col(payload))).drop("__first", "__hash", "__n").withColumn("hash", F.when(F.col("copy_id").isNull(), F.col("hash")))


def resolve_copies(df: DataFrame, id_: str = "id", payload: str = "data", among: DataFrame | None = None) -> DataFrame:
    """Fills the payload of each copy from the row of `among` (by default df) that its copy_id names; one hop, and a copy of an unknown row stays null."""
    originals = (df if among is None else among).where(F.col(payload).isNotNull()).select(F.col(id_).alias("__id"), F.col(payload).alias("__payload"))
    out = df.join(originals, F.col("copy_id") == F.col("__id"), "left")
    return out.withColumn(payload, F.coalesce("__payload", payload)).drop("__id", "__payload")


def without_tombstones(df: DataFrame) -> DataFrame:
    return df.where(F.col("copy_id").isNotNull() | F.col("hash").isNotNull())
