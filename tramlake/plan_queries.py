"""Registered queries of whole plans, sources and runners over the test tables, each with its SQL for another engine."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tramlake.functions import geo, text
from tramlake.functions.numbers import rounded
from tramlake.operators import matching, ordering
from tramlake.plans import compaction, positions, rail, segments, stops, trajectories
from tramlake.plans.nodes import Node
from tramlake.queries import DAILY, LINE, MIDDLE, QUERIES, SQL, TIES, TIMES, day, feed, query
from tramlake.sources import archives, catalog, feeds, geojson, http
from tramlake.sources.blobs import Blobs
from tramlake.streaming import incremental, runner


def registered(sql: str):
    """Registers a function of (spark, sf_dir)."""

    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(value: Column) -> Column:
    return value.cast("string")


# The city network: suppliers are stops, twenty of them a line, along the parallel of 50.5 degrees.

STEP, NORTH = 0.005, 50.5


def line_of(stop: Column) -> Column:
    return F.concat(F.lit("7"), words(F.floor(stop / 20)))


def place_of(stop: Column) -> Column:
    return geo.point(F.lit(4.0) + stop % 20 * STEP, F.lit(NORTH))


PLACES = geo.lambert_steps(f"(SELECT k, 4 + k * {STEP} AS x, {NORTH} AS y FROM range(21) AS r(k))")


@query("""
SELECT l_orderkey::VARCHAR AS route_short_name, CASE WHEN l_orderkey % 2 = 0 THEN 'V' ELSE 'F' END AS direction_id, (l_orderkey % 2)::INTEGER AS direction, l_suppkey AS stop_id,
       s_name AS stop_name, l_linenumber AS stop_sequence, s_acctbal AS stop_lat, s_nationkey::DOUBLE AS stop_lon
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_suppkey % 5 <> 0""")
def stops_of_lines(lineitem, supplier):
    """Orders as lines, with their points as JSON text; suppliers as stops, one in five without a place."""
    point = F.struct(F.concat(words(F.col("l_suppkey")), F.lit("F")).alias("id"), F.col("l_linenumber").alias("order"))
    lines = lineitem.groupBy(F.col("l_orderkey").alias("lineid")).agg(F.to_json(F.collect_list(point)).alias("points"))
    lines = lines.withColumn("direction", F.when(F.col("lineid") % 2 == 0, F.lit("City")).otherwise(F.lit("Suburb")))
    here = F.struct(F.when(F.col("s_suppkey") % 5 != 0, F.col("s_acctbal")).alias("latitude"), F.col("s_nationkey").alias("longitude"))
    name = F.when(F.col("s_suppkey") % 3 == 0, F.to_json(F.struct(F.col("s_name").alias("nl")))).otherwise(F.to_json(F.struct(F.col("s_name").alias("fr"))))
    details = supplier.select(words(F.col("s_suppkey")).alias("id"), F.to_json(here).alias("gpscoordinates"), name.alias("name"))
    return stops.stops(lines, details).drop("geometry", "place")


@query(f"""
WITH v AS ({geo.lambert_steps(f"(SELECT i, x, {NORTH} AS y FROM (VALUES (0, 3.99), (1, 4.0525), (2, 4.2)) AS t(i, x))")}),
part AS (
  SELECT a.i, a.lambert_x AS ax, a.lambert_y AS ay, b.lambert_x - a.lambert_x AS dx, b.lambert_y - a.lambert_y AS dy, sqrt(pow(b.lambert_x - a.lambert_x, 2) + pow(b.lambert_y - a.lambert_y, 2)) AS size
  FROM v a JOIN v b ON b.i = a.i + 1),
passed AS (SELECT *, coalesce(sum(size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM part),
near AS (
  SELECT k, x, i, before, size, ax, ay, dx, dy, lambert_x, lambert_y, greatest(0, least(1, ((lambert_x - ax) * dx + (lambert_y - ay) * dy) / (size * size))) AS share FROM ({PLACES}), passed),
measured AS (
  SELECT k, x, before + share * size AS distance FROM near QUALIFY row_number() OVER (PARTITION BY k ORDER BY pow(ax + share * dx - lambert_x, 2) + pow(ay + share * dy - lambert_y, 2), i) = 1),
ends AS (SELECT s_suppkey AS start, s_suppkey // 20 AS n, s_suppkey % 20 AS k, lead(s_suppkey) OVER (PARTITION BY s_suppkey // 20 ORDER BY s_suppkey) AS "end" FROM supplier)
SELECT '7' || n AS line_id, 1::INTEGER AS direction, start, "end", '#222222' AS color, round_even(a.x * 1e6, 0) / 1e6 AS x1, round_even(b.x * 1e6, 0) / 1e6 AS x2,
       (CASE ends.k WHEN 10 THEN 3 ELSE 2 END)::INTEGER AS vertices, round_even(a.distance * 1e3, 0) / 1e3 AS distance
FROM ends JOIN measured a ON a.k = ends.k JOIN measured b ON b.k = "end" % 20 WHERE "end" IS NOT NULL""")
def line_segments(supplier):
    """Two shapes a line; the one of the other variant than the stops' direction is cut at the stops."""
    key = F.col("s_suppkey")
    of = supplier.select(line_of(key).alias("route_short_name"), F.lit(0).alias("direction"), (key % 20).alias("stop_sequence"), (key % 20).alias("place"), key.alias("stop_id"), place_of(key).alias("geometry"))
    line = F.array(*(geo.point(F.lit(x), F.lit(NORTH)) for x in (3.99, 4.0525, 4.2)))
    shapes = of.select(F.concat(F.lit("0"), "route_short_name", F.lit("b")).alias("ligne")).distinct().select("ligne", F.explode(F.array(F.lit(1), F.lit(2))).alias("variante"), line.alias("geometry"))
    shapes = shapes.withColumn("color_hex", F.when(F.col("variante") == 1, F.lit("#111111")).otherwise(F.lit("#222222")))
    out = segments.segments(shapes, of)
    ends = [rounded(F.element_at("geometry", n)["x"], 6).alias(name) for n, name in ((1, "x1"), (-1, "x2"))]
    return out.select("line_id", "direction", "start", "end", "color", *ends, F.size("geometry").alias("vertices"), rounded(F.col("distance"), 3).alias("distance"))


@query(f"""
WITH lengths AS (
  SELECT a.k, sqrt(pow(b.lambert_x - a.lambert_x, 2) + pow(b.lambert_y - a.lambert_y, 2)) AS length FROM ({PLACES}) a JOIN ({PLACES}) b ON b.k = a.k + 1),
live AS (
  SELECT event_id AS vehicle, event_id % 120 AS p, event_id % 120 // 20 AS n, event_id % 20 AS k, (event_id % 500)::DOUBLE AS d, event_id % 3 = 0 AND event_id % 120 // 20 * 20 + 1 IN (SELECT s_suppkey FROM supplier) AS told
  FROM events WHERE event_id % 50 <> 0 AND event_id % 41 <> 0 AND event_id % 120 IN (SELECT s_suppkey FROM supplier))
SELECT vehicle, p::INTEGER AS "pointId", '7' || n AS "lineId", 1::INTEGER AS direction, d AS "distanceFromPoint", '#0000ff' AS color,
       round_even((4 + live.k * {STEP} + CASE WHEN live.k < 19 THEN {STEP} * least(1, d / length) ELSE 0 END) * 1e6, 0) / 1e6 AS x, {NORTH}::DOUBLE AS y,
       (CASE WHEN live.k = 19 THEN 1 WHEN told THEN 5 ELSE 4 END)::INTEGER AS confidence_score
FROM live JOIN lengths USING (k) WHERE told OR p % 4 <> 0""")
def vehicle_positions(events, supplier):
    """Events as live distances from stops: one in three names where it goes to, and one stop in four serves both directions."""
    key = F.col("s_suppkey")
    of = supplier.select(
        line_of(key).alias("route_short_name"), key.alias("stop_id"), F.col("s_name").alias("stop_name"), (key % 20).alias("stop_sequence"), F.lit(NORTH).alias("stop_lat"), place_of(key)["x"].alias("stop_lon"),
        F.explode(F.when(key % 4 == 0, F.array(F.lit("V"), F.lit("F"))).otherwise(F.array(F.lit("V")))).alias("direction_id"),
    )
    pieces = supplier.where(key % 20 < 19).select(key.alias("start"), line_of(key).alias("line_id"), F.lit(1).alias("direction"), F.array(place_of(key), place_of(key % 20 + 1)).alias("geometry"), F.lit("#0000ff").alias("color"))
    event, p = F.col("event_id"), F.col("event_id") % 120
    live = events.select(
        event.alias("vehicle"), F.when(event % 50 == 0, F.lit("7100")).otherwise(F.concat(words(p), F.lit("G"))).alias("pointId"),
        F.when(event % 41 == 0, F.lit("")).otherwise(F.concat(line_of(p), F.lit(".0"))).alias("lineId"),
        F.when(event % 3 == 0, words(F.floor(p / 20) * 20 + 1)).otherwise(F.lit("9999")).alias("directionId"), (event % 500).alias("distanceFromPoint"),
    )
    out = positions.positions(live, pieces, of)
    return out.select("vehicle", "pointId", "lineId", "direction", "distanceFromPoint", "color", rounded(F.col("geometry.x"), 6).alias("x"), "geometry.y", "confidence_score")


@query(TIMES + """
SELECT a.l_orderkey::VARCHAR AS trip_id, a.o_orderstatus AS trip_headsign, upper(s.s_name) AS name_start, upper(e.s_name) AS name_end, a.l_suppkey::VARCHAR AS ptcarid_start, b.l_suppkey::VARCHAR AS ptcarid_end,
       round_even((a.l_suppkey + (b.l_suppkey - a.l_suppkey) * ((36000 - a.at) / (b.at - a.at))) * 1e6, 0) / 1e6 AS x, round_even((36000 - a.at) / (b.at - a.at) * 1e6, 0) / 1e6 AS y
FROM times a JOIN times b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 JOIN supplier s ON s.s_suppkey = a.l_suppkey JOIN supplier e ON e.s_suppkey = b.l_suppkey
WHERE a.at < 36000 AND b.at > 36000 AND (a.l_suppkey + b.l_suppkey) % 3 <> 0""")
def rail_positions(orders, lineitem, supplier):
    """Trips of the timetable at ten o'clock, on the segments between stations; a third of the segments are not known."""
    tables = feed(orders, lineitem, supplier)
    ends = matching.with_successor(ordering.first_of_group(lineitem, LINE, TIES).select(*LINE, "l_suppkey"), "l_orderkey", "l_linenumber", ["l_suppkey"])
    a, b = F.col("l_suppkey"), F.col("l_suppkey_next")
    known = ends.where((a + b) % 3 != 0).select(a.alias("a"), b.alias("b")).distinct()
    pieces = known.select(words(F.col("a")).alias("stationfrom_id"), words(F.col("b")).alias("stationto_id"), F.array(geo.point(F.col("a"), F.lit(0)), geo.point(F.col("b"), F.lit(1))).alias("geometry"))
    points = supplier.select(words(F.col("s_suppkey")).alias("ptcarid"), F.col("s_name").alias("longnamefrench"), F.lower("s_name").alias("commerciallongnamefrench"))
    out = rail.positions(tables, pieces, points, datetime(2024, 1, 3, 10))
    return out.select("trip_id", "trip_headsign", "name_start", "name_end", "ptcarid_start", "ptcarid_end", rounded(F.col("geometry.x"), 6).alias("x"), rounded(F.col("geometry.y"), 6).alias("y"))


# Feeds


@query("""
SELECT c_custkey AS number, c_name AS name_fr, lower(c_name) AS name_nl, c_mktsegment AS address_fr, c_mktsegment AS address_nl, 'a' AS municipality_fr, 'b' AS municipality_nl,
       c_custkey % 9 AS available_bikes, c_custkey % 5 AS available_bike_stands, 20::INTEGER AS bike_stands, '2024' AS last_update, c_acctbal AS x, c_nationkey::DOUBLE AS y
FROM customer WHERE c_custkey % 7 <> 0""")
def bike_stations(customer):
    key = F.col("c_custkey")
    records = customer.select(
        key.alias("number"), F.col("c_name").alias("name_fr"), F.lower("c_name").alias("name_nl"), F.col("c_mktsegment").alias("address_fr"), F.col("c_mktsegment").alias("address_nl"),
        F.lit("a").alias("mu_fr"), F.lit("b").alias("mu_nl"), (key % 9).alias("available_bikes"), (key % 5).alias("available_bike_stands"), F.lit(20).alias("bike_stands"), F.lit("2024").alias("last_update"),
        F.when(key % 7 != 0, F.struct(F.col("c_acctbal").alias("lon"), F.col("c_nationkey").alias("lat"))).alias("geo_point_2d"), F.lit("more").alias("other"),
    )
    return feeds.bike_stations(records).select("*", "geometry.x", "geometry.y").drop("geometry")


@query("""
SELECT c_custkey AS id, c_mktsegment AS "category", round_even((3 + (c_custkey % 300) / 100.0) * 1e7, 0) / 1e7 AS x, round_even((49.5 + (c_custkey % 200) / 100.0) * 1e7, 0) / 1e7 AS y
FROM customer WHERE c_custkey % 6 <> 0""")
def incidents(customer):
    """Incidents in metres; one in six has no place."""
    at = geo.to_lambert(geo.point(3.0 + (F.col("c_custkey") % 300) / 100.0, 49.5 + (F.col("c_custkey") % 200) / 100.0))
    near = customer.withColumn("at", at)
    here = F.struct(F.when(F.col("c_custkey") % 6 != 0, F.col("at.x")).alias("x"), F.col("at.y").alias("y"))
    out = feeds.incidents(near.select(F.col("c_custkey").alias("id"), F.struct(F.col("c_mktsegment").alias("category")).alias("kind"), F.struct(here.alias("coordinates")).alias("location")))
    return out.select("id", F.col("`kind.category`").alias("category"), rounded(F.col("geometry.x"), 7).alias("x"), rounded(F.col("geometry.y"), 7).alias("y"))


@query("""SELECT event_id::VARCHAR AS id, 'station ' || user_id AS station, event_type AS phenomenon, value AS "lastValue", user_id::DOUBLE AS x, 50.5::DOUBLE AS y FROM events""")
def air_quality(events):
    station = F.struct(
        F.struct(F.array(F.col("user_id").cast("double"), F.lit(50.5), F.lit(None)).alias("coordinates"), F.lit("Point").alias("type")).alias("geometry"), F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("station "), "user_id").alias("label")).alias("properties"),
    )
    parameters = F.struct(F.struct(F.lit("1").alias("id"), F.lit("l").alias("label")).alias("service"), F.struct(F.col("event_type").alias("label")).alias("phenomenon"))
    series = events.select(words(F.col("event_id")).alias("id"), station.alias("station"), parameters.alias("parameters"), F.struct("value").alias("lastValue"), F.array(F.lit("x")).alias("extras"))
    out = feeds.air_quality(series)
    named = {"id": "id", "station.properties.label": "station", "parameters.phenomenon.label": "phenomenon", "lastValue.value": "lastValue"}
    return out.select(*(F.col(f"`{c}`").alias(n) for c, n in named.items()), "geometry.x", "geometry.y")


@query("""SELECT l_partkey::VARCHAR AS "directionId", l_linenumber AS "distanceFromPoint", l_suppkey::VARCHAR AS "pointId", l_orderkey::VARCHAR AS "lineId" FROM lineitem""")
def vehicle_distances(lineitem):
    """A payload an order: its positions as text for even orders, else as an array."""
    item = F.struct(words(F.col("l_partkey")).alias("directionId"), F.col("l_linenumber").alias("distanceFromPoint"), words(F.col("l_suppkey")).alias("pointId"))
    packed = lineitem.groupBy("l_orderkey").agg(F.collect_list(item).alias("p"))
    as_text = F.to_json(F.array(F.struct(words(F.col("l_orderkey")).alias("lineid"), F.to_json("p").alias("vehiclepositions"))))
    as_array = F.to_json(F.array(F.struct(words(F.col("l_orderkey")).alias("lineid"), F.col("p").alias("vehiclepositions"))))
    return feeds.vehicle_distances(packed.select(F.when(F.col("l_orderkey") % 2 == 0, as_text).otherwise(as_array).alias("data")))


@query("""SELECT c_custkey AS bike_id, c_mktsegment AS unit, c_acctbal AS x, c_nationkey::DOUBLE AS y FROM customer""")
def shared_vehicles(customer):
    item = F.struct(F.col("c_custkey").alias("bike_id"), F.col("c_acctbal").alias("lon"), F.col("c_nationkey").alias("lat"), F.struct(F.col("c_mktsegment").alias("unit")).alias("pricing"))
    payloads = customer.groupBy(F.floor(F.col("c_custkey") / 100)).agg(F.to_json(F.struct(F.struct(F.collect_list(item).alias("bikes")).alias("data"))).alias("data"))
    out = feeds.shared_vehicles(payloads, "bike_id:bigint,lat:double,lon:double,pricing:struct<unit:string>")
    return out.select("bike_id", F.col("`pricing.unit`").alias("unit"), "geometry.x", "geometry.y")


@query("SELECT c_custkey AS a, c_name AS b, c_acctbal AS d FROM customer")
def flattened_members(customer):
    nested = customer.select(F.col("c_custkey").alias("a"), F.struct(F.col("c_name").alias("b"), F.struct(F.col("c_acctbal").alias("d"), F.col("c_nationkey").alias("gone")).alias("c")).alias("s"))
    kept = geojson.without(geojson.flattened(nested), ["s.c.gone"])
    return kept.select("a", F.col("`s.b`").alias("b"), F.col("`s.c.d`").alias("d"))


@query("""
SELECT o_orderkey, (o_orderkey % 900 + 1)::INTEGER AS stop, (o_orderkey % 90 + 1)::INTEGER AS line, CASE WHEN o_orderkey % 2 = 0 THEN 'V' ELSE 'F' END AS letter, (o_orderkey % 2 + 1)::INTEGER AS number FROM orders""")
def live_codes(orders):
    key = F.col("o_orderkey")
    direction = F.when(key % 2 == 0, F.lit("City")).otherwise(F.lit("Suburb"))
    suffix = F.element_at(F.array(*map(F.lit, ("F", "G", "", "PA"))), (key % 4 + 1).cast("int"))
    return orders.select(
        "o_orderkey", text.live_stop_number(F.concat(words(key % 900 + 1), suffix)).alias("stop"), text.shape_line_number(F.concat(F.lit("0"), words(key % 90 + 1), F.lit("t"))).alias("line"),
        text.direction_letter(direction).alias("letter"), text.direction_number(text.direction_letter(direction)).alias("number"),
    )


# Sources that bring their own transport or files: the smallest tables, whose size is fixed


def answers(rows: list[dict]):
    """A transport that gives pages of rows, by offset or by number, to who has the second of three keys or needs none."""

    def transport(url: str, params: dict, headers: dict, form: dict | None = None) -> tuple[int, bytes]:
        if form is not None:
            return 200, json.dumps({"access_token": form["client_id"] + form["client_secret"]}).encode()
        if url == "guarded" and headers.get("Authorization") not in ("b", "Bearer me+s"):
            return 401, b""
        size = params.get("limit", params.get("size", len(rows)))
        at = params.get("offset", params.get("page", 0) * size)
        page = {"totalPages": -(-len(rows) // size)}
        return 200, json.dumps({"total_count": len(rows), "page": page, "_embedded": {"response": rows[at : at + size]}, "results": rows[at : at + size]}).encode()

    return transport


def nations(spark: SparkSession, sf_dir: str, secrets: dict | None = None, **options) -> DataFrame:
    rows = [{"k": r.n_nationkey, "name": r.n_name} for r in table(spark, sf_dir, "nation").collect()]
    http.register(spark, answers(rows), "nations", secrets)
    found = spark.read.format("nations").options(**({"url": "open"} | options)).load()
    return found.select(F.from_json("value", "struct<k:int,name:string>").alias("v")).select(F.col("v.k").alias("n_nationkey"), F.col("v.name").alias("n_name"))


NATIONS = "SELECT n_nationkey, n_name FROM nation"


@registered(NATIONS)
def http_pages_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir, pagination="offset", page_size=10)


@registered(NATIONS)
def http_pages_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir, pagination="page", page_size=4, results="_embedded.response", total="page.totalPages")


@registered(NATIONS)
def http_any_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir, {"KEY": "a", "KEY_1": "b", "KEY_2": "c"}, url="guarded", token_key="KEY")


@registered(NATIONS)
def http_client_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir, {"ME": "me+", "SECRET": "s"}, url="guarded", token_url="token", client_key="ME", secret_key="SECRET")


def zipped(spark: SparkSession, files: dict[str, bytes]) -> DataFrame:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, data in files.items():
            archive.writestr(name, data)
    return spark.createDataFrame([(bytearray(buffer.getvalue()),)], "content binary")


@registered("SELECT n_nationkey::VARCHAR AS route_id, n_name AS route_long_name, r_name AS agency_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def timetable_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timetable feed in a zip, to tables, to Parquet and back."""
    files = {}
    for name, source, columns in (("routes", "nation", {"n_nationkey": "route_id", "n_name": "route_long_name", "n_regionkey": "agency_id"}), ("agency", "region", {"r_regionkey": "agency_id", "r_name": "agency_name"})):
        out = io.StringIO()
        writer = csv.writer(out)
        writer.writerows([columns.values(), *([r[c] for c in columns] for r in table(spark, sf_dir, source).collect())])
        files[f"feed/{name}.txt"] = ("﻿" + out.getvalue()).encode()
    folder = compaction.shared_folder(spark, "timetable")
    archives.gtfs_to_parquet(archives.gtfs_from_zip(zipped(spark, files)), folder)
    back = archives.gtfs_from_parquet(spark, folder, ["routes", "agency"])
    return back["routes"].join(back["agency"], "agency_id").select("route_id", "route_long_name", "agency_name")


@registered("SELECT n_name AS member, n_nationkey::VARCHAR AS text FROM nation")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = {r.n_name: str(r.n_nationkey).encode() for r in table(spark, sf_dir, "nation").collect()}
    return archives.zip_maps(zipped(spark, files)).select(F.explode("members").alias("member", "text"))


def number(n: int) -> bytes:
    """A protocol buffer's variable-length integer."""
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def member(key: int, value: int | bytes) -> bytes:
    return number(key << 3 | 2) + number(len(value)) + value if isinstance(value, bytes) else number(key << 3) + number(value)


@registered("""
SELECT n_nationkey::VARCHAR AS trip_id, '08:00:00' AS start_time, '20240103' AS start_date, n_name AS stop_id, (n_nationkey * 10 - 100)::INTEGER AS arrival_delay, (1700000000 + n_nationkey)::BIGINT AS arrival_time
FROM nation WHERE n_nationkey % 4 <> 0""")
def live_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live timetable messages, one a region; one trip in four has no arrival."""
    messages: dict[int, bytes] = {}
    for r in table(spark, sf_dir, "nation").collect():
        trip = member(1, str(r.n_nationkey).encode()) + member(2, b"08:00:00") + member(3, b"20240103")
        event = member(1, r.n_nationkey * 10 - 100) + (member(2, 1_700_000_000 + r.n_nationkey) if r.n_nationkey % 4 else b"")
        update = member(3, member(1, trip) + member(2, member(4, r.n_name.encode()) + member(2, event)))
        messages[r.n_regionkey] = messages.get(r.n_regionkey, b"") + member(2, member(1, b"id") + update)
    return archives.live_updates(spark.createDataFrame([(bytearray(m),) for m in messages.values()], "content binary"))


@registered("SELECT r_regionkey, r_name AS content FROM region")
def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a region, put, found again by its path, and one of them deleted and put back."""
    store = Blobs(spark, compaction.shared_folder(spark, "blobs"))
    rows = table(spark, sf_dir, "region").collect()
    paths = [store.put("regions", datetime(2024, 1, 1 + r.r_regionkey), r.r_name) for r in rows]
    store.delete(paths[0])
    store.put("regions", datetime(2024, 1, 1 + rows[0].r_regionkey), rows[0].r_name)
    return spark.createDataFrame([(r.r_regionkey, store.get(p).decode()) for r, p in zip(rows, paths, strict=True)], "r_regionkey int, content string")


@registered("SELECT TIMESTAMP '2024-01-01 04:00:00' + to_days(r_regionkey) AS date, count(n_name)::BIGINT AS row_count FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL")
def blob_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs, a region's nations each, to the items of a validated batch."""
    store = Blobs(spark, compaction.shared_folder(spark, "blobs"))
    nations = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(F.col("n_name").alias("name")))).alias("data"))
    for r in nations.collect():
        store.put("nations", datetime(2024, 1, 1 + r.n_regionkey, 4), r.data)
    items, _ = compaction.batch(store.snapshots("nations"), "struct<name:string>", {"name": "string"}, "name")
    return items.groupBy("date").agg(F.count("*").alias("row_count"))


# The catalog and its runners


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN (props ->> '$.k') WHEN 1 THEN props ELSE event_type END AS payload FROM events")
def payload_kinds(events):
    """JSON, text and bytes by their kind."""
    kind = F.element_at(F.array(*map(F.lit, ("json", "text", "gtfs"))), (F.col("event_id") % 3 + 1).cast("int"))
    rows = events.select(F.col("event_id").alias("id"), kind.alias("type"), F.when(kind == "gtfs", F.base64(F.col("event_type").cast("binary"))).otherwise(F.col("props")).alias("data"))
    parts = [
        catalog.decoded(rows, "json").select("id", words(F.variant_get("payload", "$.k", "long")).alias("payload")), catalog.decoded(rows, "text").select("id", "payload"),
        catalog.decoded(rows, "gtfs").select("id", F.col("payload").cast("string").alias("payload")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).withColumnRenamed("id", "event_id")


@query(f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{MIDDLE}' ORDER BY ts LIMIT 100")
def slice_by_count(events):
    return incremental.next_slice(events.select("event_id", "ts"), MIDDLE, 100, time="ts")


@query(f"SELECT event_id, ts FROM events WHERE ts >= date_trunc('day', TIMESTAMP '{MIDDLE}') AND ts < date_trunc('day', TIMESTAMP '{MIDDLE}') + INTERVAL 1 DAY")
def slice_by_period(events):
    return incremental.next_slice(events.select("event_id", "ts"), MIDDLE + timedelta(hours=7), "1d", time="ts")


@registered("""
WITH days AS (SELECT date, n, row_number() OVER (ORDER BY date) AS place FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS date, sum(event_id) AS n FROM events GROUP BY 1))
SELECT max(date) AS date, (sum(sum(n)) OVER (ORDER BY (place - 1) // 14))::BIGINT AS total FROM days GROUP BY (place - 1) // 14""")
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node that feeds on its own last output: slices of fourteen days, the last one shorter, each added to the total so far."""
    store = catalog.Catalog(spark, compaction.shared_folder(spark, "totals"))
    days = table(spark, sf_dir, "events").groupBy(day().alias("date")).agg(F.sum("event_id").alias("n"))
    store.append("days", days.select("date", words(F.col("n")).alias("data")), "text")

    def add(days: DataFrame, total: DataFrame | None) -> DataFrame:
        both = days.select("data") if total is None else days.select("data").union(total.select("data"))
        return both.agg(words(F.sum(F.col("data").cast("long"))).alias("data"))

    runner.derive_all(store, Node("total", "harvesters", add, "text", source="days", source_range=14, strict=False, optional=[("total", 1)]))
    return store.read("total").select("date", F.col("data").cast("long").alias("total"))


DOCUMENTS = """
WITH documents AS (
  SELECT ts, event_type, event_id % 97 <> 0 AS valid, strlen('[{"lineId":"' || event_type || '","pointId":"' || event_id || '"}]') AS size FROM events WHERE ts < TIMESTAMP '2024-01-30'),
days AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS start_date, count(*) FILTER (valid) AS docs, count(*) FILTER (NOT valid) AS skipped, coalesce(sum(size) FILTER (valid), 0) AS size FROM documents GROUP BY 1),
weeks AS (
  SELECT date_trunc('week', start_date)::TIMESTAMP AS start_date, sum(docs) AS docs, sum(skipped) AS skipped, sum(size) AS size FROM days WHERE start_date < TIMESTAMP '2024-01-29' GROUP BY 1),
parts AS (SELECT date_trunc('week', ts)::TIMESTAMP AS start_date, event_type, count(*) AS n FROM documents WHERE valid GROUP BY ALL)
"""


@registered(DOCUMENTS + """
SELECT '1d' AS level, start_date, (start_date + INTERVAL 1 DAY)::TIMESTAMP AS end_date, docs::BIGINT AS doc_count, docs::BIGINT AS row_count, skipped::BIGINT AS skipped, size::BIGINT AS original_size, NULL::VARCHAR AS "lineId" FROM days
UNION ALL SELECT '1w', start_date, (start_date + INTERVAL 7 DAY)::TIMESTAMP, docs::BIGINT, n::BIGINT, skipped::BIGINT, floor(size * n / docs)::BIGINT, event_type FROM weeks JOIN parts USING (start_date)""")
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and keyed weeks of snapshots, in two runs; a document is an event, one in 97 of them invalid."""
    events = table(spark, sf_dir, "events")
    item = F.concat(F.lit('[{"lineId":"'), "event_type", F.lit('","pointId":"'), "event_id", F.lit('"}]'))
    documents = events.select(F.col("ts").alias("date"), F.when(F.col("event_id") % 97 != 0, item).otherwise(F.lit('[{"pointId": 5}]')).alias("data"))
    store = compaction.Archive(spark, compaction.shared_folder(spark, "archive"), [("1d", []), ("1w", ["lineId"])])
    for end in (datetime(2024, 1, 10), datetime(2024, 1, 30)):
        store.run(documents, "struct<lineId:string,pointId:string>", {"pointId": "string"}, "lineId", end)
    return store.manifest().select("level", "start_date", "end_date", "doc_count", "row_count", "skipped", "original_size", F.col("keys")["lineId"].alias("lineId"))


# Trajectories of the two networks


def moving(events, **properties: Column) -> DataFrame:
    """A snapshot an hour: events as moving points."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    rows = events.select(hour.alias("date"), "user_id", "event_id", geo.point(F.col("value"), F.col("event_id")).alias("geometry"))
    once = ordering.first_of_group(rows, ["date", "user_id"], ["event_id"])
    return geojson.collections(once.select("date", *(c.alias(n) for n, c in properties.items()), "geometry"), ["date"])


HOURLY = """
SELECT {id} AS {name}, count(*)::BIGINT AS n, string_agg(strftime(date, '%Y-%m-%dT%H:%M:%S.%fZ'), ',' ORDER BY date) AS datetimes FROM (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS date, user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts), user_id ORDER BY event_id) = 1)
WHERE date > TIMESTAMP '2024-01-04' AND date < TIMESTAMP '2024-01-21' GROUP BY user_id HAVING count(*) > 1"""
SPAN = tuple(int((d - datetime(1970, 1, 1)).total_seconds()) for d in (datetime(2024, 1, 4), datetime(2024, 1, 21)))


def listed(found: DataFrame, name: str) -> DataFrame:
    times = F.from_json(F.get_json_object("feature", "$.temporalGeometry.datetimes"), "array<string>")
    return found.select(name, F.size(times).cast("long").alias("n"), F.array_join(times, ",").alias("datetimes"))


@query(HOURLY.format(id="'u' || user_id", name="uuid"))
def vehicle_trips(events):
    user = F.concat(F.lit("u"), "user_id")
    shots = moving(events, uuid=user, lineId=words(F.col("user_id")), direction=F.lit(1), color=F.lit("#000000"), pointId=F.col("event_id"), distanceFromPoint=F.lit(1.0), distance=F.lit(2.0))
    return listed(trajectories.vehicle_trips(shots, *SPAN), "uuid")


@query(HOURLY.format(id="'t' || user_id", name="trip_id"))
def train_trips(events):
    trip, user = F.concat(F.lit("t"), "user_id"), words(F.col("user_id"))
    shots = moving(events, trip_id=trip, trip_headsign=user, name_start=user, name_end=user, ptcarid_start=user, ptcarid_end=user)
    return listed(trajectories.train_trips(shots, *SPAN), "trip_id")


@query(f"SELECT date, uuid, value AS x FROM ({DAILY}) WHERE date = (SELECT max(date) FROM ({DAILY}))")
def latest_snapshot(events):
    """The features of the newest snapshot."""
    rows = events.select(day().alias("date"), words(F.col("user_id")).alias("uuid"), F.col("event_id").alias("pointId"), geo.point(F.col("value"), F.col("event_id")).alias("geometry"))
    newest = rows.where(F.col("date") == rows.select(F.max("date")).scalar())
    shots = geojson.collections(ordering.first_of_group(newest, ["date", "uuid"], ["pointId"]), ["date"], "uuid")
    return geojson.features(shots, "uuid string, pointId long").select("date", "uuid", "geometry.x")


@registered("SELECT date_trunc('week', ts)::TIMESTAMP AS week, event_type, count(*)::BIGINT AS n, round_even(sum(value) * 1e4, 0) / 1e4 AS total FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly windows of a stream with a watermark, as its last state."""
    folder = compaction.shared_folder(spark, "windows")
    table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").write.parquet(f"{folder}/in")
    source = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{folder}/in")
    totals = runner.tumbling(source, "ts", timedelta(weeks=1), ["event_type"], "value", timedelta(hours=1))
    keep = lambda rows, n: rows.write.mode("overwrite").parquet(f"{folder}/out")
    totals.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.parquet(f"{folder}/out")
    return back.select(F.col("window.start").cast("timestamp_ntz").alias("week"), "event_type", "n", rounded(F.col("total"), 4).alias("total"))


__all__ = ["QUERIES", "SQL"]
