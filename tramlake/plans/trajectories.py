"""Trajectories: ordered lists a key, and Moving-Features JSON."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tramlake.functions.time import iso_micros
from tramlake.operators import ordering

#: Snapshots that an on-demand query reads at most, and its default span.
SNAPSHOTS, SPAN = 2000, timedelta(hours=1)


def ordered_list(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], least: int = 1) -> DataFrame:
    """One row a key with `items`, the rows' values in order; keys with fewer than `least` rows are left out."""
    item = F.struct(*(F.col(o).alias(f"__o{k}") for k, o in enumerate(order)), *(F.col(v).alias(v) for v in values))
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("__items")).where(F.size("__items") >= least)
    return packed.select(*keys, F.transform("__items", lambda x: F.struct(*(x[v].alias(v) for v in values))).alias("items"))


def span(start: int | None, end: int | None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """The interval asked for in epoch seconds: an hour after or before the bound given, or the last hour."""
    moment = lambda s: datetime(1970, 1, 1) + timedelta(seconds=int(s))
    if start is None and end is None:
        now = now or datetime.now(tz=None)
        return now - SPAN, now
    return (moment(end) - SPAN if start is None else moment(start)), (moment(start) + SPAN if end is None else moment(end))


def points(snapshots: DataFrame, features: str, start: datetime, end: datetime, limit: int = SNAPSHOTS) -> DataFrame:
    """The features of the first `limit` snapshots strictly between two times, stamped with their snapshot's time.

    `features` is the schema of the feature array in each snapshot's JSON payload.
    """
    chosen = ordering.between(snapshots.select("date", "data"), "date", start, end, limit, ordered=False)
    parsed = chosen.select("date", F.from_json("data", f"struct<features:{features}>").alias("payload"))
    return parsed.select("date", F.posexplode("payload.features").alias("position", "feature"))


def mf_json(
    rows: DataFrame, id_: str, time: str, point: str = "geometry", static: Sequence[str] = (), temporal: Sequence[str] = (), fields: dict[str, dict[str, str]] | None = None,
    interpolation: str | None = None, crs: dict | None = None, trs: dict | None = None, order: Sequence[str] = (),
) -> DataFrame:
    """A feature a trajectory as Moving-Features JSON text, column `feature`.

    Static properties are those of a trajectory's first row; temporal ones are listed beside the times, with further fixed
    fields (such as a unit) from `fields`.
    """
    item = F.struct(F.col(time).alias("t"), *(F.col(o).alias(f"o{k}") for k, o in enumerate(order)), F.col(point).alias("p"), F.struct(*static, F.lit(0).alias("__")).alias("s"), *(F.col(v).alias(f"v_{v}") for v in temporal))
    packed = rows.groupBy(F.col(id_).alias("__id")).agg(F.array_sort(F.collect_list(item)).alias("i"))
    times = F.transform("i", lambda x: x["t"])
    geometry = [F.lit("MovingPoint").alias("type"), F.transform("i", lambda x: F.array(x["p"]["x"], x["p"]["y"])).alias("coordinates"), times.alias("datetimes")]
    if interpolation:
        geometry.append(F.lit(interpolation).alias("interpolation"))
    first = F.col("i")[0]["s"]
    parts = [F.lit("Feature").alias("type"), F.struct(F.col("__id").alias(id_), *(first[c].alias(c) for c in static)).alias("properties"), F.struct(*geometry).alias("temporalGeometry")]
    for name, value in (("crs", crs), ("trs", trs)):
        if value:
            parts.append(literal(value).alias(name))
    if temporal:
        values = lambda v: F.transform("i", lambda x: x[f"v_{v}"])
        listed = [F.struct(values(v).alias("values"), *(F.lit(x).alias(k) for k, x in ((fields or {}).get(v) or {}).items())).alias(v) for v in temporal]
        parts.append(F.array(F.struct(times.alias("datetimes"), *listed)).alias("temporalProperties"))
    return packed.select(F.col("__id").alias(id_), F.to_json(F.struct(*parts)).alias("feature"))


def literal(value) -> Column:
    """A nested Python dict as a struct literal."""
    if isinstance(value, dict):
        return F.struct(*(literal(v).alias(k) for k, v in value.items()))
    return F.lit(value)


def trajectories(snapshots: DataFrame, features: str, id_: str, start: int | None = None, end: int | None = None, drop: Sequence[str] = (), now: datetime | None = None) -> DataFrame:
    """Trajectories of the moving points in a table of GeoJSON snapshots; those of a single point are left out."""
    rows = points(snapshots, features, *span(start, end, now)).withColumn("datetimes", iso_micros(F.col("date")))
    names = [f.name for f in rows.schema["feature"].dataType["properties"].dataType.fields]
    xy = F.col("feature.geometry.coordinates")
    flat = rows.select("datetimes", "position", F.struct(xy[0].alias("x"), xy[1].alias("y")).alias("geometry"), "feature.properties.*")
    kept = ordering.several(flat, [id_])
    return mf_json(kept, id_, "datetimes", static=[n for n in names if n != id_ and n not in drop], order=["position"])


def collection(features: DataFrame) -> DataFrame:
    """All features as one FeatureCollection: one row, for a thin service that asked for a bounded interval."""
    joined = F.array_join(F.array_sort(F.collect_list("feature")), ",")
    return features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("value"))


# What snapshots of the city network and of trains hold.
VEHICLES = "array<struct<properties:struct<uuid:string,lineId:string,direction:int,color:string,pointId:bigint,distanceFromPoint:double,distance:double>,geometry:struct<coordinates:array<double>>>>"
TRAINS = "array<struct<properties:struct<trip_id:string,trip_headsign:string,name_start:string,name_end:string,ptcarid_start:string,ptcarid_end:string>,geometry:struct<coordinates:array<double>>>>"


def vehicle_trips(snapshots: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Trajectories of identified vehicles, by uuid."""
    return trajectories(snapshots, VEHICLES, "uuid", start, end, drop=["distance", "distanceFromPoint", "pointId"])


def train_trips(snapshots: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Trajectories of trains, by trip."""
    return trajectories(snapshots, TRAINS, "trip_id", start, end)
