"""Archives in binary columns: zip members, timetable feeds, shapefiles, live timetable messages."""

from __future__ import annotations

import csv
import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tramlake.functions import geo

#: Members of a timetable feed that this library reads, with their columns' types where they are not text.
GTFS = {"stops": {"stop_lat": "double", "stop_lon": "double"}, "trips": {}, "stop_times": {"stop_sequence": "int"}, "calendar": {}, "calendar_dates": {}, "routes": {}, "agency": {}, "shapes": {}}


def zip_members(files: DataFrame, column: str = "content") -> DataFrame:
    """A row a member of each zip file: name and text (null where it is not UTF-8); files that are no zip give none."""
    others = [c for c in files.columns if c != column]

    def read(batches):
        for batch in batches:
            for k, data in enumerate(batch.column(column).to_pylist()):
                for name, text in members(data):
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(k, 1) for c in others), pa.array([name]), pa.array([text], pa.string())], names=[*others, "member", "text"])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in files.dtypes if c != column), "member string", "text string"])
    return files.mapInArrow(read, schema)


def members(data: bytes | None) -> Iterator[tuple[str, str | None]]:
    try:
        with zipfile.ZipFile(io.BytesIO(data or b"")) as archive:
            for name in archive.namelist():
                if not name.endswith("/"):
                    try:
                        yield name, archive.read(name).decode("utf-8")
                    except UnicodeDecodeError:
                        yield name, None
    except zipfile.BadZipFile:
        return


def zip_maps(files: DataFrame, column: str = "content") -> DataFrame:
    """Each zip file's members as one map of name to text."""
    others = [c for c in files.columns if c != column]
    packed = zip_members(files, column).groupBy(*others).agg(F.map_from_entries(F.collect_list(F.struct("member", "text"))).alias("members"))
    return packed


def gtfs_feed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of an unpacked timetable feed (name.txt), by name."""
    out = {}
    jvm = spark._jvm
    for name, kinds in GTFS.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.txt")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            rows = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(f"{folder}/{name}.txt")
            out[name] = rows.withColumns({c: F.col(c).try_cast(t) for c, t in kinds.items() if c in rows.columns})
    return out


def gtfs_from_zip(files: DataFrame, column: str = "content") -> dict[str, DataFrame]:
    """The tables of a timetable zip: a task reads a member's rows; columns come from the members' first lines."""
    texts = zip_members(files.select(column), column).where(F.col("text").isNotNull())
    heads = texts.select(F.regexp_extract("member", r"([^/]+)\.txt$", 1).alias("name"), F.substring_index(F.regexp_replace("text", "^﻿", ""), "\n", 1).alias("head"))
    out = {}
    for name, head in ((r.name, r["head"]) for r in heads.where(F.col("name").isin(*GTFS)).collect()):  # one short line a table
        columns = [c.strip() for c in next(csv.reader([head.strip()]))]

        def rows(batches, columns=columns):
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    lines = csv.reader(io.StringIO(text.lstrip("﻿")))
                    next(lines, None)
                    cells = [(line + [None] * len(columns))[: len(columns)] for line in lines if line]
                    yield pa.RecordBatch.from_arrays([pa.array([c[k] or None for c in cells], pa.string()) for k in range(len(columns))], names=columns)

        member = texts.where(F.regexp_extract("member", r"([^/]+)\.txt$", 1) == name).select("text")
        table = member.mapInArrow(rows, ", ".join(f"`{c}` string" for c in columns))
        out[name] = table.withColumns({c: F.col(c).try_cast(t) for c, t in GTFS[name].items() if c in columns})
    return out


def gtfs_to_parquet(feed: dict[str, DataFrame], folder: str) -> None:
    for name, table in feed.items():
        table.write.option("compression", "zstd").parquet(f"{folder}/{name}")


def gtfs_from_parquet(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


# Protocol buffers: a field's number and wire type precede its value.


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = varint(data, at)
        elif wire == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire}")
        yield key >> 3, value


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def trip_updates(message: bytes) -> Iterator[dict]:
    """Of each trip update its first stop with an arrival time; updates without one are left out."""
    for number, entity in fields(message):
        if number != 2:
            continue
        for kind, update in fields(entity):
            if kind != 3:
                continue
            trip, stops = {}, []
            for part, value in fields(update):
                if part == 1:
                    trip = {n: v.decode() for n, v in fields(value) if isinstance(v, bytes)}
                elif part == 2:
                    stop = {"stop_id": "", "arrival_delay": 0, "arrival_time": 0}
                    for n, v in fields(value):
                        if n == 4:
                            stop["stop_id"] = v.decode()
                        elif n == 2:
                            event = dict(fields(v))
                            delay = signed(event.get(1, 0))
                            stop |= {"arrival_delay": delay, "arrival_time": signed(event.get(2, 0))}
                    stops.append(stop)
            first = next((s for s in stops if s["arrival_time"]), None)
            if first:
                yield {"trip_id": trip.get(1, ""), "start_time": trip.get(2, ""), "start_date": trip.get(3, "")} | first


UPDATES = {"trip_id": pa.string(), "start_time": pa.string(), "start_date": pa.string(), "stop_id": pa.string(), "arrival_delay": pa.int32(), "arrival_time": pa.int64()}


def live_updates(messages: DataFrame, column: str = "content") -> DataFrame:
    """Rows of the live timetable messages in a binary column, with the messages' other columns."""
    others = [c for c in messages.columns if c != column]

    def read(batches):
        for batch in batches:
            for k, data in enumerate(batch.column(column).to_pylist()):
                rows = [*trip_updates(data or b"")]
                same = [pa.array(batch.column(c).slice(k, 1).to_pylist() * len(rows), batch.schema.field(c).type) for c in others]
                yield pa.RecordBatch.from_arrays([*same, *(pa.array([r[c] for r in rows], t) for c, t in UPDATES.items())], names=[*others, *UPDATES])

    kinds = {pa.string(): "string", pa.int32(): "int", pa.int64(): "bigint"}
    schema = ", ".join([*(f"`{c}` {t}" for c, t in messages.dtypes if c != column), *(f"{c} {kinds[t]}" for c, t in UPDATES.items())])
    return messages.mapInArrow(read, schema)


# Shapefiles


def dbf_rows(data: bytes) -> list[dict[str, str]]:
    """Records of a dBase table as text; deleted ones are None."""
    count, head, size = struct.unpack_from("<IHH", data, 4)
    columns, at = [], 32
    while data[at] != 0x0D:
        columns.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    out = []
    for k in range(count):
        start, row = head + k * size + 1, {}
        for name, width in columns:
            row[name] = data[start : start + width].decode("utf-8", "replace").strip()
            start += width
        out.append(row if data[head + k * size : head + k * size + 1] != b"*" else None)
    return out


def shp_lines(data: bytes) -> list[list[tuple[float, float]] | None]:
    """Points of each polyline record, parts one after the other; None for a record without shape."""
    at, out = 100, []
    while at + 8 <= len(data):
        size = struct.unpack_from(">I", data, at + 4)[0] * 2
        kind = struct.unpack_from("<I", data, at + 8)[0]
        if kind % 10 == 3:
            parts, points = struct.unpack_from("<II", data, at + 44)
            xy = struct.unpack_from(f"<{2 * points}d", data, at + 52 + 4 * parts)
            out.append([*zip(xy[::2], xy[1::2], strict=True)])
        else:
            out.append(None)
        at += 8 + size
    return out


def line_shapes(files: DataFrame, column: str = "content") -> DataFrame:
    """The line layer of shapefile zips (metres) as ligne, variante, color_hex and geometry in degrees, in reading order."""

    def read(batches):
        for batch in batches:
            for data in batch.column(column).to_pylist():
                with zipfile.ZipFile(io.BytesIO(data)) as archive:
                    named = {n.rpartition("/")[2].lower(): n for n in archive.namelist()}
                    layer = next((n[:-4] for n in named if n.endswith(".shp") and ("lines" in n or "lignes" in n)), None)
                    if layer is None:
                        continue
                    rows = dbf_rows(archive.read(named[f"{layer}.dbf"]))
                    lines = shp_lines(archive.read(named[f"{layer}.shp"]))
                    for row, line in zip(rows, lines, strict=False):
                        if row is None or line is None:
                            continue
                        cells = {{"linecode": "ligne", "colorhex": "color_hex"}.get(k.lower(), k.lower()): v for k, v in row.items()}
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([cells.get("ligne")]), pa.array([int(float(cells["variante"])) if cells.get("variante") else None], pa.int32()), pa.array([cells.get("color_hex")], pa.string()),
                                pa.array([[{"x": x, "y": y} for x, y in line]], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))),
                            ],
                            names=["ligne", "variante", "color_hex", "geometry"],
                        )

    metres = files.select(column).mapInArrow(read, "ligne string, variante int, color_hex string, geometry array<struct<x:double,y:double>>")
    return metres.withColumn("geometry", F.transform("geometry", geo.to_degrees))
