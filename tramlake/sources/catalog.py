"""The append-only catalog of snapshots: time-indexed tables, with payloads stored once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tramlake.functions.time import blob_name
from tramlake.operators import matching, ordering

SCHEMA = "id bigint, date timestamp_ntz, data string, type string, hash string, copy_id bigint"


class Catalog:
    """Snapshot tables under one folder: table=.../day=... Parquet. Reads between times touch the days between them; they leave tombstones
    out, and resolve copies of the rows that are left after a limit."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, table: str) -> str:
        return f"{self.folder}/table={table}"

    def create(self, tables) -> None:
        """Makes each table that is not there."""
        for t in tables:
            if not self.exists(t):
                self._write(self.spark.createDataFrame([], SCHEMA), t)

    def _write(self, rows: DataFrame, table: str) -> None:
        rows.withColumn("day", F.date_format("date", "yyyy-MM-dd")).write.mode("append").partitionBy("day").parquet(self._path(table))

    def exists(self, table: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def raw(self, table: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """All rows, copies as pointers, tombstones included; of the days from that of `start` to that of `end`, if given."""
        if not self.exists(table):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(f"{SCHEMA}, day string").parquet(self._path(table))
        if start is not None:
            rows = rows.where(F.col("day") >= f"{start:%Y-%m-%d}")
        if end is not None:
            rows = rows.where(F.col("day") <= f"{end:%Y-%m-%d}")
        return rows.drop("day")

    def stored(self, table: str, start: datetime | None = None, end: datetime | None = None, with_null: bool = False) -> DataFrame:
        """The rows that reads are made of: copies are still pointers."""
        rows = self.raw(table, start, end)
        return rows if with_null else matching.without_tombstones(rows)

    def resolved(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows of stored(), with the payloads of copies, in their order."""
        return matching.resolve_copies(rows, among=self.raw(table))

    def read(self, table: str, with_null: bool = False) -> DataFrame:
        return self.resolved(table, self.stored(table, with_null=with_null))

    def _in_order(self, table: str, rows: DataFrame, newest: bool) -> DataFrame:
        return self.resolved(table, rows).orderBy(F.col("date").desc() if newest else F.col("date").asc())

    def latest(self, table: str, with_null: bool = False) -> DataFrame:
        return self.resolved(table, ordering.newest(self.stored(table, with_null=with_null), "date"))

    def first(self, table: str) -> DataFrame:
        return self.resolved(table, ordering.oldest(self.stored(table), "date"))

    def after(self, table: str, date: datetime, n: int | None = None) -> DataFrame:
        return self._in_order(table, ordering.after(self.stored(table, date), "date", date, n, ordered=False), True)

    def before(self, table: str, date: datetime, n: int | None = None) -> DataFrame:
        return self._in_order(table, ordering.before(self.stored(table, end=date), "date", date, n, ordered=False), True)

    def between(self, table: str, start: datetime | None = None, end: datetime | None = None, n: int | None = None) -> DataFrame:
        return self._in_order(table, ordering.between(self.stored(table, start, end), "date", start, end, n, ordered=False), False)

    def within(self, table: str, start: datetime, end: datetime) -> DataFrame:
        return self.resolved(table, ordering.within(self.stored(table, start, end), "date", start, end))

    def last_date(self, table: str) -> datetime | None:
        """Time of the newest row, tombstones included."""
        return self.raw(table).agg(F.max("date")).first()[0]

    def append(self, table: str, results: DataFrame, kind: str = "json", share: bool = True) -> None:
        """results: date and data (null for a tombstone), text or bytes; bytes are kept as base64. Every row is added, also one of a date that the table has
        already, or without a date (which no read between times gives). Ids go on from the largest one, in the order of dates, null dates first; with
        `share`, a payload that the table has already, or that comes twice, is stored as a pointer. A write that broke off leaves nothing."""
        held = self.raw(table)
        base = held.agg(F.max("id")).first()[0] or 0
        numbered = ordering.numbered(results, ["date"], F.date_trunc("day", "date"), "__n").select((F.col("__n") + base).cast("long").alias("id"), "date", "data")
        kept = F.base64("data") if dict(results.dtypes)["data"] == "binary" else F.col("data").cast("string")
        rows = numbered.select("id", "date", kept.alias("data"), F.lit(kind).alias("type"), F.md5(F.col("data").cast("binary")).alias("hash"))
        if share:
            known = held.where("hash IS NOT NULL AND copy_id IS NULL").groupBy("hash").agg(F.min("id").alias("__known"))
            first = rows.where("hash IS NOT NULL").groupBy("hash").agg(F.min("id").alias("__first"))
            rows = rows.join(first.join(known, "hash", "left").select("hash", F.coalesce("__known", "__first").alias("__to")), "hash", "left")
            copy = F.coalesce(F.col("__to") != F.col("id"), F.lit(False))
            rows = rows.select("id", "date", F.when(~copy, F.col("data")).alias("data"), "type", F.when(~copy, F.col("hash")).alias("hash"), F.when(copy, F.col("__to")).alias("copy_id"))
        else:
            rows = rows.withColumn("copy_id", F.lit(None).cast("long"))
        self._write(rows, table)


def blob_path(table: str, date: Column) -> Column:
    """Where a payload is put when it is kept as a file."""
    return F.concat(F.lit(f"{table}/"), blob_name(date))


def decoded(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of one payload kind: `json` as a variant, `text` as text, anything else as bytes."""
    own = rows.where(F.col("type") == kind)
    if kind == "json":
        return own.withColumn("payload", F.parse_json("data"))
    return own.withColumn("payload", F.col("data") if kind == "text" else F.unbase64("data"))
