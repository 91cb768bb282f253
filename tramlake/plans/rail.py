"""Train positions from the timetable: how far each running train is between two stations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tramlake.functions import geo, text
from tramlake.operators import matching
from tramlake.plans import gtfs


def underway(stop_times: DataFrame, at: int) -> DataFrame:
    """Trips between a stop and the next in sequence at a second of the day, with the share of the way that is done."""
    pairs = matching.with_successor(stop_times.select("trip_id", "stop_sequence", "stop_id", "arrival_time"), "trip_id", "stop_sequence", ["stop_id", "arrival_time"])
    now = pairs.where((F.col("arrival_time") < at) & (F.col("arrival_time_next") > at))
    return now.withColumn("percentage", (F.lit(at) - F.col("arrival_time")) / (F.col("arrival_time_next") - F.col("arrival_time")))


def delayed(stop_times: DataFrame, updates: DataFrame) -> DataFrame:
    """Stop times moved by the delay of their trip's live update, where there is one."""
    late = updates.groupBy("trip_id").agg(F.max("arrival_delay").alias("__delay"))
    return stop_times.join(late, "trip_id", "left").withColumn("arrival_time", F.col("arrival_time") + F.coalesce("__delay", F.lit(0))).drop("__delay")


def positions(feed: dict[str, DataFrame], segments: DataFrame, points: DataFrame, at: datetime, updates: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """A point a train underway whose stations and segment are known; several where names have several operational points.

    compat compares names as first written down: the platform mark stays, and the end's name keeps its spaces.
    """
    day = gtfs.on_date(feed, at.date())
    times = delayed(day["stop_times"], updates) if updates is not None else day["stop_times"]
    now = underway(times, at.hour * 3600 + at.minute * 60 + at.second)
    names = feed["stops"].select("stop_id", "stop_name")
    for side, column in (("start", "stop_id"), ("end", "stop_id_next")):
        now = now.join(names.select(F.col("stop_id").alias(column), F.col("stop_name").alias(f"stop_name_{side}")), column)
    variants = F.explode(F.array("longnamefrench", "commerciallongnamefrench")).alias("name")
    stations = points.select("ptcarid", variants).select("ptcarid", text.operator_station_key(F.col("name")).alias("name")).distinct()
    upper = lambda c: F.upper(F.col(c))
    start = F.translate(upper("stop_name_start"), " ", "") if compat else text.station_key(F.col("stop_name_start"))
    end = upper("stop_name_end") if compat else text.station_key(F.col("stop_name_end"))
    work = now.select("trip_id", "percentage", start.alias("name_start"), end.alias("name_end"))
    for side in ("start", "end"):
        work = work.join(stations.select(F.col("name").alias(f"name_{side}"), F.col("ptcarid").alias(f"ptcarid_{side}")), f"name_{side}")
    on = (F.col("stationfrom_id") == F.col("ptcarid_start")) & (F.col("stationto_id") == F.col("ptcarid_end"))
    final = segments.where(F.col("geometry").isNotNull()).join(work, on).join(feed["trips"].select("trip_id", "trip_headsign"), "trip_id")
    here = geo.interpolate(F.col("geometry"), F.col("percentage"), normalised=True)
    return final.select("trip_id", "trip_headsign", "name_start", "name_end", "ptcarid_start", "ptcarid_end", here.alias("geometry"))
