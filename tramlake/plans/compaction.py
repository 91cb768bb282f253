"""Compaction of snapshots into time-bucketed, keyed Parquet, with a manifest of what each file set holds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tramlake.functions import time
from tramlake.functions.numbers import rounded
from tramlake.sources.blobs import Blobs

MANIFEST = (
    "level string, start_date timestamp_ntz, end_date timestamp_ntz, doc_count bigint, row_count bigint, skipped bigint, original_size bigint, "
    "keys map<string,string>, data string"
)


def level_statistics(documents: DataFrame, levels: Sequence[str], at: str = "date") -> DataFrame:
    """Documents, skipped documents and bytes a bucket: the first level from the documents, each further one from the level before.

    documents: a time, `valid` and `size`; invalid documents count as skipped and have no size.
    """
    valid, out = F.col("valid"), None
    base = time.bucket(F.col(at), time.period(levels[0])).alias("start")
    level = documents.groupBy(base).agg(F.count_if(valid).alias("documents"), F.count_if(~valid).alias("skipped"), F.coalesce(F.sum(F.when(valid, F.col("size"))), F.lit(0)).cast("long").alias("size"))
    for k, name in enumerate(levels):
        if k:
            upper = time.bucket(F.col("start"), time.period(name)).alias("start")
            level = level.groupBy(upper).agg(*(F.sum(c).cast("long").alias(c) for c in ("documents", "skipped", "size")))
        rows = level.select(F.lit(name).alias("level"), "start", "documents", "skipped", "size")
        out = rows if out is None else out.unionByName(rows)
    return out


def keyed_statistics(rows: DataFrame, level: str, keys: Sequence[str], at: str = "date") -> DataFrame:
    """Rows a bucket and key, and the bucket's bytes shared out by rows."""
    start = time.bucket(F.col(at), time.period(level))
    parts = rows.groupBy(start.alias("start"), *keys).agg(F.count("*").alias("row_count"), F.sum("size").alias("__size"))
    whole = parts.groupBy("start").agg(F.sum("__size").alias("__whole"), F.sum("row_count").alias("__rows"))
    return parts.join(whole, "start").select("start", *keys, "row_count", rounded(F.col("__whole") / F.col("__rows") * F.col("row_count"), 6).alias("size"))


def closed_and_half_open(rows: DataFrame, at: str, delta: timedelta, name: str) -> DataFrame:
    """Rows a bucket with both ends included (a row on a boundary counts twice) and with the end left out."""
    start = time.bucket(F.col(at), delta)
    earlier = F.when(F.col(at) == start, start - F.expr(f"INTERVAL '{int(delta.total_seconds())}' SECOND"))
    copies = F.explode(F.filter(F.array(F.struct(start.alias("b"), F.lit(1).alias("own")), F.struct(earlier.alias("b"), F.lit(0).alias("own"))), lambda x: x["b"].isNotNull()))
    return rows.select(copies.alias("c")).groupBy(F.col("c.b").alias(name)).agg(F.count("*").alias("closed"), F.sum("c.own").alias("half_open"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that all executors share."""
    import tempfile

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tramlake-")
    return f"{base}/{name}-{uuid4().hex}"


def written_by_key(rows: DataFrame, keys: Sequence[str], folder: str | None = None, compression: str = "gzip") -> DataFrame:
    """Writes a folder a key and returns what is read back. A key's rows come from as many tasks as hold them: nothing is shuffled."""
    folder = folder or shared_folder(rows.sparkSession, "keyed")
    rows.write.option("compression", compression).option("parquet.compression.codec.zlib.level", "9").partitionBy(*keys).parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def valid_items(items: Column, types: dict[str, str]) -> Column:
    """Whether a variant is an array of objects whose members, where present, have the given JSON types (string or integer)."""
    accepted = {"string": ("STRING",), "integer": ("BIGINT", "INT", "SMALLINT", "TINYINT")}

    def fits(x: Column) -> Column:
        ok = F.schema_of_variant(x).startswith("OBJECT")
        for name, kind in types.items():
            member = F.schema_of_variant(F.try_variant_get(x, f"$.{name}", "variant"))
            present = F.try_variant_get(x, f"$.{name}", "variant").isNotNull()
            ok = ok & (~present | member.isin(*accepted[kind]))
        return ok

    array = F.try_variant_get(items, "$", "array<variant>")
    return F.schema_of_variant(items).startswith("ARRAY") & F.coalesce(F.forall(array, fits), F.lit(False))


def batch(snapshots: DataFrame, item: str, types: dict[str, str], key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The items of all valid documents (with the document's date, the key as text), and per document date, valid and size.

    A document is valid as a whole or not at all; text that is no JSON raises.
    """
    parsed = snapshots.select("date", "data", F.parse_json("data").alias("__json")).withColumn("valid", valid_items(F.col("__json"), types))
    items = parsed.where("valid").select("date", F.inline(F.from_json("data", f"array<{item}>")))
    if key:
        items = items.withColumn(key, F.col(key).cast("string")).where(F.col(key).isNotNull())
    return items, parsed.select("date", "valid", F.octet_length("data").alias("size"))


def complete_periods(first: datetime, end: datetime, level: str, resume: datetime | None = None) -> list[tuple[datetime, datetime]]:
    """The periods [start, start + level) that end by `end`, from the one of `first`, or from where the last run ended."""
    delta = time.period(level)
    at, out = time.floor(resume or first, delta), []
    while at + delta <= end:
        out.append((at, at + delta))
        at += delta
    return out


class Archive:
    """A folder of set=/level=/start= Parquet file sets with a manifest; each run adds the periods that are complete by then.

    Periods include their start and leave out their end. A period is written to a new folder and becomes visible with its manifest
    row, so a broken run can be run again. File sets that a level without keys replaced stay until vacuum() deletes them.
    """

    def __init__(self, spark: SparkSession, folder: str, levels: Sequence[tuple[str, Sequence[str]]]):
        """levels: (period, keys) from fine to coarse; a level with keys keeps its parts, one without replaces them."""
        self.spark, self.folder, self.levels = spark, folder, list(levels)

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def _replaced(self, rows: DataFrame) -> DataFrame:
        """Those of the manifest rows whose period lies in one of a coarser level without keys."""
        out = rows.limit(0)
        for k, (level, keys) in enumerate(self.levels[1:], 1):
            if not keys:
                finer = [name for name, _ in self.levels[:k]]
                bucket = time.bucket(F.col("start_date"), time.period(level))
                done = rows.where(F.col("level") == level).select(F.col("start_date").alias("__start")).distinct()
                out = out.unionByName(rows.where(F.col("level").isin(finer)).join(done, bucket == F.col("__start"), "left_semi"))
        return out

    def current(self) -> DataFrame:
        """Manifest rows that no coarser level without keys replaced."""
        rows = self.manifest()
        return rows.join(self._replaced(rows).select("level", "start_date").distinct(), ["level", "start_date"], "left_anti")

    def vacuum(self) -> int:
        """Deletes the file sets that were replaced; the manifest keeps their rows, by which later runs know what is done."""
        paths = [r.data for r in self._replaced(self.manifest()).select("data").distinct().collect()]  # one path a file set
        blobs = Blobs(self.spark, self.folder)
        return sum(blobs.delete(p) for p in paths)

    def _done(self, level: str) -> datetime | None:
        return self.manifest().where(F.col("level") == level).agg(F.max("end_date")).first()[0]

    def _add(self, rows: DataFrame) -> None:
        rows.select(*(c.split()[0] for c in MANIFEST.split(", "))).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def run(self, snapshots: DataFrame, item: str, types: dict[str, str], key: str | None, end: datetime) -> list[tuple[str, datetime]]:
        """Compacts everything up to `end`; returns what was added as (level, start)."""
        first = snapshots.agg(F.min("date")).first()[0]
        if first is None:
            return []
        added = []
        base, keys = self.levels[0]
        periods = complete_periods(first, end, base, self._done(base))
        if periods:
            new = snapshots.where((F.col("date") >= time.moment(periods[0][0])) & (F.col("date") < time.moment(periods[-1][1])))
            added += self._write(*batch(new, item, types, key), base, keys)
        for (lower, lower_keys), (level, keys) in zip(self.levels, self.levels[1:], strict=False):
            done = self._done(level)
            ended = self._done(lower)
            if ended is None:
                continue
            start = self.manifest().where(F.col("level") == lower).agg(F.min("start_date")).first()[0]
            periods = complete_periods(start, ended, level, done)
            if not periods:
                continue
            inside = (F.col("start_date") >= time.moment(periods[0][0])) & (F.col("start_date") < time.moment(periods[-1][1])) & (F.col("level") == lower)
            parts = self.manifest().where(inside)
            paths = [r.data for r in parts.select("data").distinct().collect()]  # one path a file set
            rows = self.spark.read.option("basePath", self.folder).option("mergeSchema", "true").parquet(*paths).drop("set", "level", "start", *(f"{k}_key" for k in lower_keys))
            added += self._write(rows, parts, level, keys)
        return added

    def _write(self, rows: DataFrame, documents: DataFrame, level: str, keys: Sequence[str]) -> list[tuple[str, datetime]]:
        delta = time.period(level)
        start, folder = time.bucket(F.col("date"), delta), f"{self.folder}/set={uuid4().hex}"
        named = rows.withColumn("level", F.lit(level)).withColumn("start", F.date_format(start, "yyyy-MM-dd_HH-mm-ss"))
        codec = "snappy" if level == self.levels[0][0] else "gzip"
        named.withColumns({f"{k}_key": F.col(k) for k in keys}).write.option("compression", codec).partitionBy("level", "start", *(f"{k}_key" for k in keys)).parquet(folder)
        if "valid" in documents.columns:
            counted = documents.groupBy(start.alias("start_date")).agg(F.count_if("valid").alias("doc_count"), F.count_if(~F.col("valid")).alias("skipped"), F.coalesce(F.sum(F.when(F.col("valid"), F.col("size"))), F.lit(0)).cast("long").alias("size"))
        else:
            once = documents.groupBy("level", "start_date").agg(F.max("doc_count").alias("doc_count"), F.max("skipped").alias("skipped"), F.sum("original_size").alias("original_size"))
            counted = once.groupBy(time.bucket(F.col("start_date"), delta).alias("start_date")).agg(F.sum("doc_count").alias("doc_count"), F.sum("skipped").alias("skipped"), F.sum("original_size").alias("size"))
        # A bucket's size is shared out by rows where its rows are split by key.
        parts = rows.groupBy(start.alias("start_date"), *keys).agg(F.count("*").alias("row_count"))
        whole = parts.groupBy("start_date").agg(F.sum("row_count").alias("rows"))
        manifest = counted.join(parts, "start_date", "left").join(whole, "start_date", "left").select(
            F.lit(level).alias("level"), "start_date", (F.col("start_date") + F.expr(f"INTERVAL '{int(delta.total_seconds())}' SECOND")).alias("end_date"), "doc_count",
            F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), "skipped",
            F.coalesce(F.floor(F.col("size") * F.col("row_count") / F.col("rows")), F.col("size")).cast("long").alias("original_size"),
            (F.create_map(*(x for k in keys for x in (F.lit(k), F.col(k).cast("string")))) if keys else F.lit(None).cast("map<string,string>")).alias("keys"),
            F.concat(F.lit(f"{folder}/level={level}/start="), F.date_format("start_date", "yyyy-MM-dd_HH-mm-ss")).alias("data"),
        ).where("row_count > 0 OR skipped > 0")
        self._add(manifest)
        return sorted({(level, r[0]) for r in manifest.select("start_date").distinct().collect()})
