"""Stops of each line and direction, from the lists of lines and the details of stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramlake.functions import geo, text

POINTS = "array<struct<id:string,order:int>>"


def stops(lines: DataFrame, details: DataFrame) -> DataFrame:
    """lines: lineid, direction, points (JSON text); details: id, gpscoordinates and name (JSON text).

    Of details with the same stop number the last in reading order counts; stops without coordinates are left out.
    """
    number = text.stop_number(F.col("id"))
    here = F.from_json("gpscoordinates", "struct<latitude:double,longitude:double>")
    known = details.select(number.alias("stop_id"), here.alias("here"), text.member(F.col("name"), "$.fr", "$.nl").alias("stop_name"), F.monotonically_increasing_id().alias("__at"))
    known = known.where("stop_id <> 0 AND here.latitude IS NOT NULL AND here.longitude IS NOT NULL")
    last = known.groupBy("stop_id").agg(F.max_by(F.struct("here", "stop_name"), "__at").alias("d"))
    points = F.posexplode(F.from_json("points", POINTS)).alias("__place", "point")
    rows = lines.select(F.col("lineid").cast("string").alias("route_short_name"), text.direction_letter(F.col("direction")).alias("direction_id"), points)
    rows = rows.select(
        "route_short_name", "direction_id", F.when(F.col("direction_id") == "V", 0).otherwise(1).alias("direction"), text.stop_number(F.col("point.id")).alias("stop_id"),
        F.coalesce("point.order", F.lit(0)).alias("stop_sequence"), "__place",
    )
    found = rows.join(last, "stop_id")
    return found.select(
        "route_short_name", "direction_id", "direction", "stop_id", F.col("d.stop_name").alias("stop_name"), "stop_sequence",
        F.col("d.here.latitude").alias("stop_lat"), F.col("d.here.longitude").alias("stop_lon"), geo.point(F.col("d.here.longitude"), F.col("d.here.latitude")).alias("geometry"), F.col("__place").alias("place"),
    )
