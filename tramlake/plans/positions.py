"""Vehicle positions: live distances from stops, placed on the segments of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tramlake.functions import geo, text
from tramlake.operators import ordering

#: Stop numbers of this range belong to depots.
DEPOT_FROM, DEPOT_TO = 7000, 7200


def prepared(live: DataFrame, id_: str = "vehicle", compat: bool = False) -> DataFrame:
    """live: pointId, lineId, directionId, distanceFromPoint and a row id. Codes become numbers; depots and empty lines go."""
    rows = live.select(
        id_, text.live_stop_number(F.col("pointId")).alias("pointId"), text.live_stop_number(F.col("directionId")).alias("directionId"),
        text.live_line_name(F.col("lineId").cast("string"), compat).alias("line_id"), F.col("distanceFromPoint").cast("double").alias("distanceFromPoint"),
    )
    return rows.where(((F.col("pointId") > DEPOT_TO) | (F.col("pointId") < DEPOT_FROM)) & F.col("line_id").isNotNull() & (F.col("line_id") != ""))


def matched(rows: DataFrame, stops: DataFrame, id_: str = "vehicle") -> DataFrame:
    """Rows with the stop they are at: confidence 5 where their destination tells the direction, 4 where the stop serves one direction only."""
    names = ["stop_id", "stop_name", "stop_sequence", "stop_lat", "stop_lon", "direction_id"]
    of = stops.select(F.col("route_short_name").alias("line_id"), *names)
    towards = of.select("line_id", F.col("stop_id").alias("directionId"), "direction_id", "stop_sequence")
    known = ordering.first_of_group(rows.join(towards, ["line_id", "directionId"]), [id_], [F.col("stop_sequence").desc(), F.col("direction_id").desc()]).drop("stop_sequence")
    at = of.withColumnRenamed("stop_id", "pointId")
    sure = known.join(at, ["pointId", "line_id", "direction_id"]).withColumn("confidence_score", F.lit(5))
    rest = rows.join(sure.select(id_).distinct(), id_, "left_anti")
    maybe = rest.join(at, ["pointId", "line_id"]).withColumn("__n", F.count("*").over(W.partitionBy(id_)))
    return sure.unionByName(maybe.where("__n = 1").drop("__n").withColumn("confidence_score", F.lit(4))).withColumn("direction", text.direction_number(F.col("direction_id")))


def positions(live: DataFrame, segments: DataFrame, stops: DataFrame, id_: str = "vehicle", compat: bool = False) -> DataFrame:
    """A point a vehicle that could be matched: on its segment, or at its stop (confidence 1) where it has none.

    A segment is as long as it is in metres; compat measures it in degrees instead, which puts nearly all vehicles at its end.
    """
    rows = matched(prepared(live, id_, compat), stops, id_)
    length = geo.length(F.col("geometry") if compat else F.transform("geometry", geo.to_lambert))
    first = segments.withColumn("__at", F.monotonically_increasing_id()).withColumn("length", length)
    first = ordering.first_of_group(first, ["start", "line_id", "direction"], ["__at"]).select(F.col("start").alias("pointId"), "line_id", "direction", F.col("geometry").alias("segment"), "length")
    placed = rows.join(first, ["pointId", "line_id", "direction"], "left")
    on = F.when(F.col("segment").isNotNull(), geo.interpolate(F.col("segment"), F.when(F.col("length") > 0, F.col("distanceFromPoint") / F.col("length")).otherwise(0.0), normalised=True))
    placed = placed.withColumn("geometry", F.coalesce(on, F.when(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull(), geo.point(F.col("stop_lon"), F.col("stop_lat")))))
    colors = segments.groupBy("line_id").agg(F.max("color").alias("color"))
    out = placed.where(F.col("geometry").isNotNull()).join(colors, "line_id", "left")
    return out.select(
        id_, "pointId", F.col("line_id").alias("lineId"), "direction", "distanceFromPoint", F.coalesce("color", F.lit(text.UNKNOWN_COLOR)).alias("color"), "geometry",
        F.when(F.col("segment").isNull(), F.lit(1)).otherwise(F.col("confidence_score")).alias("confidence_score"),
    )
