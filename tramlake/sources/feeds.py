"""What open-data feeds look like, and the tables that they become."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramlake.functions import geo, text
from tramlake.sources import geojson

# Positions and codes of aircraft state vectors.
POSITION_SOURCES = {0: "ADS-B", 1: "ASTERIX", 2: "MLAT", 3: "FLARM"}
CATEGORIES = dict(enumerate((
    "No information at all", "No ADS-B Emitter Category Information", "Light (< 15500 lbs)", "Small (15500 to 75000 lbs)", "Large (75000 to 300000 lbs)",
    "High Vortex Large (aircraft such as B-757)", "Heavy (> 300000 lbs)", "High Performance (> 5g acceleration and 400 kts)", "Rotorcraft", "Glider / sailplane", "Lighter-than-air",
    "Parachutist / Skydiver", "Ultralight / hang-glider / paraglider", "Reserved", "Unmanned Aerial Vehicle", "Space / Trans-atmospheric vehicle", "Surface Vehicle – Emergency Vehicle",
    "Surface Vehicle – Service Vehicle", "Point Obstacle (includes tethered balloons)", "Cluster Obstacle", "Line Obstacle",
)))
STATES = {
    "icao24": "string", "callsign": "string", "origin_country": "string", "time_position": "bigint", "last_contact": "bigint", "longitude": "double", "latitude": "double",
    "baro_altitude": "double", "on_ground": "boolean", "velocity": "double", "true_track": "double", "vertical_rate": "double", "sensors": "string", "geo_altitude": "double",
    "squawk": "string", "spi": "boolean", "position_source": "int", "category": "int",
}


def aircraft(payloads: DataFrame, box: tuple[float, float, float, float] | None = None, column: str = "data") -> DataFrame:
    """Rows of state vectors (arrays whose tail may be absent), inside a box of west, south, east, north if given."""
    vectors = payloads.select(F.explode(F.from_json(column, "struct<states:array<array<string>>>")["states"]).alias("s"))
    cells = [F.try_element_at("s", F.lit(k + 1)).try_cast(kind).alias(name) for k, (name, kind) in enumerate(STATES.items())]
    rows = vectors.select(*cells).dropna(subset=["longitude", "latitude"])
    rows = rows.withColumn("callsign", F.trim("callsign")).withColumn("position_source", text.mapped(F.col("position_source"), POSITION_SOURCES))
    rows = rows.withColumn("category", text.mapped(F.col("category"), CATEGORIES)).withColumn("geometry", geo.point(F.col("longitude"), F.col("latitude")))
    return (rows.where(geo.in_box(F.col("geometry"), *box)) if box else rows).drop("longitude", "latitude")


def vehicle_distances(payloads: DataFrame, column: str = "data") -> DataFrame:
    """A row a vehicle: the entries of each line's positions, given as text or as an array, with the line's id."""
    rows = payloads.select(F.explode(F.from_json(column, "array<struct<lineid:string,vehiclepositions:string>>")).alias("r"))
    item = "array<struct<directionId:string,distanceFromPoint:int,pointId:string>>"
    return rows.select(F.inline(F.from_json("r.vehiclepositions", item)), F.col("r.lineid").alias("lineId"))


def bike_stations(records: DataFrame) -> DataFrame:
    """Stations with a place, renamed."""
    # Members of the public records and what they are called here.
    names = {
        "number": "number", "name_fr": "name_fr", "name_nl": "name_nl", "address_fr": "address_fr", "address_nl": "address_nl", "mu_fr": "municipality_fr", "mu_nl": "municipality_nl",
        "available_bikes": "available_bikes", "available_bike_stands": "available_bike_stands", "bike_stands": "bike_stands", "last_update": "last_update",
    }
    placed = records.where(F.col("geo_point_2d").isNotNull())
    return placed.select(*(F.col(a).alias(b) for a, b in names.items()), geo.point(F.col("geo_point_2d.lon"), F.col("geo_point_2d.lat")).alias("geometry"))


def shared_vehicles(payloads: DataFrame, bike: str, column: str = "data") -> DataFrame:
    """Free-floating vehicles; `bike` is the schema of an entry."""
    rows = payloads.select(F.inline(F.from_json(column, f"struct<data:struct<bikes:array<struct<{bike}>>>>")["data"]["bikes"]))
    return geojson.flattened(rows).withColumn("geometry", geo.point(F.col("lon"), F.col("lat"))).drop("lat", "lon")


def zones(payloads: DataFrame, schema: str = "variant", column: str = "data") -> DataFrame:
    """The nested member that holds a provider's geofencing zones."""
    return payloads.select(F.from_json(column, f"struct<data:struct<geofencing_zones:{schema}>>")["data"]["geofencing_zones"].alias("geofencing_zones"))


def incidents(records: DataFrame) -> DataFrame:
    """Incidents with a place, from metres to degrees."""
    flat = geojson.flattened(records)
    x, y = F.col("`location.coordinates.x`"), F.col("`location.coordinates.y`")
    placed = flat.where(x.isNotNull() & y.isNotNull()).withColumn("geometry", geo.to_degrees(geo.point(x, y)))
    return placed.drop("location.coordinates.x", "location.coordinates.y")


def air_quality(series: DataFrame) -> DataFrame:
    """Time series flattened, with the station's place; bookkeeping members go."""
    c = F.col("station.geometry.coordinates")
    rows = geojson.flattened(series.withColumn("geometry", geo.point(c[0], c[1])).withColumn("__g", F.lit(1)), 5)
    # Members that only keep the service's books.
    gone = {"referenceValues", "extras", "station.geometry.type", "station.type", "parameters.service.id", "parameters.service.label", "statusIntervals", "station.geometry.coordinates", "__g", "geometry.x", "geometry.y"}
    kept = [F.col(f"`{n}`") for n in rows.columns if n not in gone]
    return rows.select(*kept, geo.point(F.col("`geometry.x`"), F.col("`geometry.y`")).alias("geometry"))


def chosen(rows: DataFrame, columns) -> DataFrame:
    """Those of the columns that the table has, in the order asked for."""
    return rows.select(*(c for c in columns if c in rows.columns))
