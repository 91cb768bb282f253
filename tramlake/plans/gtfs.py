"""Timetables: which trips run on a date, and the schedule of stops between two times."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from threading import Event, Timer
from uuid import uuid4
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from tramlake.functions import geo, time
from tramlake.operators import ordering
from tramlake.sources import archives

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ZONE = "Europe/Brussels"
# Columns of the public timetable format that a schedule shows.
SCHEDULE = ("trip_id", "arrival_time", "departure_time", "route_id", "trip_headsign", "trip_short_name")


def active_services(calendar: DataFrame | None, calendar_dates: DataFrame | None, day: date) -> DataFrame:
    """service_id of what runs on a date: by weekday and range, plus additions, minus removals."""
    text = day.strftime("%Y%m%d")
    some = calendar if calendar is not None else calendar_dates
    out = some.select("service_id").limit(0)
    if calendar is not None:
        out = calendar.where((F.col(DAYS[day.weekday()]).cast("int") == 1) & (F.col("start_date").cast("string") <= text) & (F.col("end_date").cast("string") >= text)).select("service_id")
    if calendar_dates is not None:
        on = calendar_dates.where(F.col("date").cast("string") == text)
        out = out.union(on.where("cast(exception_type AS int) = 1").select("service_id")).join(on.where("cast(exception_type AS int) = 2"), "service_id", "left_anti")
    return out.distinct()


def in_seconds(times: DataFrame) -> DataFrame:
    """Stop times with their two times as seconds."""
    for c in ("arrival_time", "departure_time"):
        if dict(times.dtypes)[c] == "string":
            times = times.withColumn(c, time.seconds_of_day(F.col(c)))
    return times


def on_date(feed: dict[str, DataFrame], day: date) -> dict[str, DataFrame]:
    """The trips of a date, their stop times (as seconds) and the stops that they serve."""
    trips = feed["trips"].join(active_services(feed.get("calendar"), feed.get("calendar_dates"), day), "service_id", "left_semi")
    times = in_seconds(feed["stop_times"]).join(trips, "trip_id", "left_semi")
    return {"trips": trips, "stop_times": times, "stops": feed["stops"].join(times, "stop_id", "left_semi")}


def _between(feed: dict[str, DataFrame], day: date, start: int, end: int, stops: DataFrame) -> DataFrame:
    """Stop times that depart at `start` or later and arrive at `end` or earlier, with their trips and stops."""
    trips = feed["trips"].join(active_services(feed.get("calendar"), feed.get("calendar_dates"), day), "service_id", "left_semi")
    times = in_seconds(feed["stop_times"]).where((F.col("departure_time") >= start) & (F.col("arrival_time") <= end))
    rows = times.join(trips, "trip_id")
    kept = [c for c in SCHEDULE if c in rows.columns]
    return rows.select("stop_id", *kept).join(stops, "stop_id")


def schedule(feed: dict[str, DataFrame], start: int, end: int, zone: str = ZONE) -> DataFrame:
    """stop_id, stop_name, stop_lat, stop_lon, geometry and the stop's schedule between two epoch times.

    Across midnight the first day is asked from the start to its end and the last day from its beginning to a second before the
    end; each day gives rows of its own. Times of day beyond 24 hours are given without their day part.
    """
    first, last = (datetime.fromtimestamp(x, ZoneInfo(zone)) for x in (start, end))
    of_day = lambda t: t.hour * 3600 + t.minute * 60 + t.second
    # Stop times of a single day are at stops of that day; those of several, at the last day's.
    stops = (feed if first.date() == last.date() else on_date(feed, last.date()))["stops"].select("stop_id", "stop_name", "stop_lat", "stop_lon")
    if first.date() == last.date():
        days = [(first.date(), of_day(first), of_day(last))]
    else:
        whole = [(first.date() + timedelta(days=k), 0, 86399) for k in range(1, (last.date() - first.date()).days)]
        days = [(first.date(), of_day(first), 86399), *whole, (last.date(), 0, max(0, of_day(last) - 1))]
    out = None
    for day, a, b in days:
        rows = _between(feed, day, a, b, stops)
        kept = [c for c in SCHEDULE if c in rows.columns]
        entry = F.struct(*(time.clock(F.col(c)).alias(c) if c.endswith("_time") else F.col(c) for c in kept))
        order = F.struct(F.col("arrival_time").alias("a"), F.col("trip_id").alias("t"), entry.alias("e"))
        nested = rows.groupBy("stop_id", "stop_name", "stop_lat", "stop_lon").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["e"]).alias("schedule"))
        out = nested if out is None else out.unionByName(nested)
    return out.withColumn("geometry", geo.point(F.col("stop_lon"), F.col("stop_lat")))


def within_time(spark: SparkSession, seconds: float, action: Callable):
    """The result of an action, or None if its jobs were not done in time and had to be cancelled."""
    sc, group = spark.sparkContext, uuid4().hex
    sc.setJobGroup(group, "within a time limit", interruptOnCancel=True)
    late = Event()
    timer = Timer(seconds, lambda: (late.set(), sc.cancelJobGroup(group)))
    timer.start()
    try:
        result = action()
        return None if late.is_set() else result
    except Exception:
        if late.is_set():
            return None
        raise
    finally:
        timer.cancel()
        sc.setLocalProperty("spark.jobGroup.id", None)


class Feeds:
    """Timetable zips of a catalog table as Parquet, each converted once; the `most` last used ones are known."""

    def __init__(self, spark: SparkSession, folder: str, most: int = 32, seconds: float = 1800.0):
        self.spark, self.folder, self.most, self.seconds = spark, folder, most, seconds
        self.known: dict[str, list[str]] = {}

    def tables(self, newest: DataFrame) -> dict[str, DataFrame] | None:
        """The tables of the one row's zip; None if its conversion takes too long."""
        key = newest.select(F.md5(F.col("data").cast("binary"))).first()[0]
        names = self.known.pop(key, None)
        if names is None:
            feed, folder = archives.gtfs_from_zip(newest.select(F.unbase64("data").alias("content"))), f"{self.folder}/{key}-{uuid4().hex}"
            names = within_time(self.spark, self.seconds, lambda: archives.gtfs_to_parquet(feed, folder) or [folder, *feed])
            if names is None:
                return None
        self.known[key] = names
        while len(self.known) > self.most:
            del self.known[next(iter(self.known))]
        return archives.gtfs_from_parquet(self.spark, names[0], names[1:])


def schedule_at(snapshots: DataFrame, start: int, end: int, zone: str = ZONE, feeds: Feeds | None = None) -> DataFrame | None:
    """schedule() by the newest feed before the end, of a catalog table of timetable zips; None if there is none. `feeds` spares
    questions of the same feed its conversion."""
    newest = ordering.before(snapshots, "date", datetime(1970, 1, 1) + timedelta(seconds=end), 1)
    if newest.isEmpty():
        return None
    feed = feeds.tables(newest) if feeds else archives.gtfs_from_zip(newest.select(F.unbase64("data").alias("content")))
    return None if feed is None else schedule(feed, start, end, zone)
