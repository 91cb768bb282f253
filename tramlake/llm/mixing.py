"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded random order, repeated `epochs` times. Each copy of a document has a virtual finish
time: the number of its source's words up to its end, divided by the source's weight. All copies are range-sorted by it, over all sources,
and the order is cut where the total budget is reached: when a copy ends at virtual time v, each source that still has words has
had weight * v of them, and each that has run empty all of its own. Both sums are carried along the order, first over the sorted
ranges, of which a row each is left, then inside the one range that holds the cut. The virtual time V of the cut gives each source
min(epochs * size, weight * V) words, its target; the copy that a source is at then is taken in part.

Everything is DataFrame work on (doc_id, source, size), written once: texts are read once and never shuffled. Prefix sums over one
source's queue are taken in two levels, inside hash ranges of the shuffle order and over the ranges' totals; the number of ranges grows with
the documents, so a source that holds a third of all documents is spread over as many tasks as it has ranges. Tables of
a row a source and a row a range are ordered as a whole.

Defined cases: null text has size 0 and is never taken; null source is a source of its own, last in order; repeated rows
are separate documents of equal place in the queue, ordered by size (equal sizes: each row still gets a share of its own,
which of the equal rows gets it can't be told); rows of one doc_id share a range; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tramlake.llm.common import cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 17
#: Rows that a range has at most, about: of a source's queue by the first digits (2 at least) of the shuffle key, and of the global order.
ROWS = 1_000_000
DIGITS = 2


def word_count(text: Column) -> Column:
    """Number of maximal runs of anything but space and \\t..\\r; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def queued(docs: DataFrame, weights, epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """A row a document: row (a number), doc_id, source, size, source_size, weight, start (words before it in its queue); and a row a source."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"))).withColumn("row", F.monotonically_increasing_id())
    digits = max(DIGITS, ceil(log(max(1, sized.count() / ROWS), 16)))
    sized = sized.withColumn("part", F.substring("key", 1, digits))
    totals = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = F.sum("part_size").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("part_size")
    parts = totals.select("source", "part", before.alias("before"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    sources = cut(totals.groupBy("source").agg(F.sum("part_size").alias("source_size")).withColumn("weight", weight))
    # One row for a source and range, with all that its documents need.
    known = parts.alias("p").join(sources.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(F.col("p.source").alias("s"), F.col("part").alias("r"), "before", "source_size", "weight")
    inside = W.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = sized.withColumn("upto", F.sum("size").over(inside)).join(known, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("r")))
    return placed.select("row", "doc_id", "source", "size", "source_size", "weight", (F.col("before") + F.col("upto") - F.col("size")).alias("start")), sources


def served(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """A row a copy of a document, range-sorted by virtual finish: row, doc_id, source, size, source_size, weight, copy (from 0), start,
    virtual_finish, target (its source's) and taken (words of it before the cut)."""
    spark = docs.sparkSession
    placed, sources = queued(docs, weights, epochs, seed)
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("start", F.col("start") + F.col("copy") * F.col("source_size"))
    copies = copies.withColumn("virtual_finish", (F.col("start") + F.col("size")) / F.col("weight"))
    order = [F.col("virtual_finish"), F.col("source").asc_nulls_last(), F.col("copy"), F.col("row")]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), epochs * placed.count() // ROWS)
    copies = cut(copies.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()))
    whole, waiting = sources.where("source_size > 0").agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    budget, emptied, level = whole * float(share), 0, None

    # What the last copy of a source adds to the words of empty sources, and takes from the weights of those that wait.
    cap = F.col("source_size") * epochs
    last = (F.col("size") > 0) & (F.col("start") + F.col("size") == cap)
    steps = copies.select("range", "virtual_finish", "source", "copy", "row", F.when(last, cap).otherwise(0).alias("cap"), F.when(last, F.col("weight")).otherwise(0).alias("freed"))

    def passed(rows: DataFrame, by) -> DataFrame:
        """The rows beyond the budget: by when they end, the words that all sources have had are more; with what held before each of them."""
        run = W.orderBy(*by).rowsBetween(W.unboundedPreceding, 0)  # of a row a range, or of one range's rows
        upto = rows.withColumn("caps", F.sum("cap").over(run)).withColumn("frees", F.sum("freed").over(run))
        had = F.lit(emptied) + F.col("caps") + (F.lit(waiting) - F.col("frees")) * F.col("virtual_finish")
        return upto.where(had > budget).withColumn("caps", F.col("caps") - F.col("cap")).withColumn("frees", F.col("frees") - F.col("freed")).orderBy(*by)

    ends = steps.groupBy("range").agg(F.max("virtual_finish").alias("virtual_finish"), F.sum("cap").alias("cap"), F.sum("freed").alias("freed"))
    if found := passed(ends, ["range"]).first():
        emptied, waiting = emptied + found.caps, waiting - found.frees
        first = passed(steps.where(F.col("range") == found.range), order).first()
        emptied, waiting = emptied + first.caps, waiting - first.frees
        level = (budget - emptied) / waiting
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level)) if level is not None else cap.cast("double")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.floor("target") - F.col("start")))
    return copies.drop("range").withColumn("target", target).withColumn("taken", taken)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """A row a copy that the mix takes, range-partitioned and sorted by the virtual time at which what is taken of it ends: the columns of
    served(), where virtual_finish is that time. Its words are those of all targets, each rounded down."""
    copies = served(docs, **options).where("taken > 0").withColumn("virtual_finish", (F.col("start") + F.col("taken")) / F.col("weight"))
    return copies.orderBy("virtual_finish", F.col("source").asc_nulls_last(), "copy", "row").drop("row")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, source, and copies: virtual_finish and words of each copy taken, by which
    the documents of the mix are put in training order."""
    copy = F.when(F.col("taken") > 0, F.struct(((F.col("start") + F.col("taken")) / F.col("weight")).alias("virtual_finish"), F.col("taken").alias("words")))
    same = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    rows = served(docs, **options).groupBy("row").agg(*same, F.sum("taken").alias("taken"), F.first("source").alias("source"), F.array_sort(F.collect_list(copy)).alias("copies"))
    return rows.drop("row")


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, (sum(size) * {EPOCHS})::BIGINT AS cap,
         (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight
  FROM sized GROUP BY source),
tried AS (
  SELECT *, ((SELECT sum(source_size)::BIGINT FROM per) * {SHARE}::DOUBLE
             - (sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap)::BIGINT)
            / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS try
  FROM per),
level AS (SELECT max(try) AS v FROM tried WHERE try <= cap / weight),
target AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(weight * v, cap::DOUBLE)) AS target FROM per, level),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS start
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - start)) + greatest(0, least(size, floor(target)::BIGINT - start - source_size)))::BIGINT AS taken
FROM queued
"""
