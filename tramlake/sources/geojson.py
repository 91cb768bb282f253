"""GeoJSON and nested JSON: reading features, writing collections, flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tramlake.functions import geo

COORDINATES = {"Point": "array<double>", "LineString": "array<array<double>>"}


def features(rows: DataFrame, properties: str, kind: str = "Point", column: str = "data") -> DataFrame:
    """The features of the collections in a text column: the rows' other columns, the properties and `geometry`. Feature ids are not kept."""
    schema = f"struct<features:array<struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:{COORDINATES[kind]}>>>>"
    others = [c for c in rows.columns if c != column]
    each = rows.select(*others, F.explode(F.from_json(column, schema)["features"]).alias("f"))
    xy = F.col("f.geometry.coordinates")
    shape = geo.point(xy[0], xy[1]) if kind == "Point" else F.transform(xy, lambda c: geo.point(c[0], c[1]))
    return each.select(*others, "f.properties.*", F.when(xy.isNotNull(), shape).alias("geometry"))


def encoded(geometry: Column, kind: str = "Point") -> Column:
    xy = F.array(geometry["x"], geometry["y"]) if kind == "Point" else F.transform(geometry, lambda p: F.array(p["x"], p["y"]))
    return F.struct(F.lit(kind).alias("type"), xy.alias("coordinates"))


def feature(rows: DataFrame, id_: str | None = None, kind: str = "Point") -> DataFrame:
    """One column `feature`, GeoJSON text a row; the id is a column's value."""
    names = [c for c in rows.columns if c != "geometry"]
    parts = [F.lit("Feature").alias("type"), F.struct(*names).alias("properties"), encoded(F.col("geometry"), kind).alias("geometry")]
    if id_:
        parts.insert(0, F.col(id_).cast("string").alias("id"))
    return rows.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("feature"))


def collections(rows: DataFrame, by: Sequence[str], id_: str | None = None, kind: str = "Point") -> DataFrame:
    """A FeatureCollection a group (such as a snapshot's date): the group's columns and `data`."""
    names = [c for c in rows.columns if c not in (*by, "geometry")]
    parts = [F.lit("Feature").alias("type"), F.struct(*names).alias("properties"), encoded(F.col("geometry"), kind).alias("geometry")]
    if id_:
        parts.insert(0, F.col(id_).cast("string").alias("id"))
    listed = F.array_sort(F.collect_list(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})))
    joined = rows.groupBy(*by).agg(F.array_join(listed, ",").alias("__features"))
    return joined.select(*by, F.concat(F.lit('{"type":"FeatureCollection","features":['), "__features", F.lit("]}")).alias("data"))


def flattened(rows: DataFrame, depth: int | None = None) -> DataFrame:
    """Members of nested structs as columns with dotted names, down to `depth` levels (all by default)."""

    def leaves(kind: T.DataType, column: Column, name: str, level: int):
        if isinstance(kind, T.StructType) and (depth is None or level <= depth):
            for f in kind.fields:
                yield from leaves(f.dataType, column[f.name], f"{name}.{f.name}" if name else f.name, level + 1)
        else:
            yield column.alias(name)

    return rows.select(*(x for f in rows.schema.fields for x in leaves(f.dataType, F.col(f"`{f.name}`"), f.name, 1)))


def without(rows: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Drops columns; a strict call refuses names that are not there."""
    if strict and (missing := set(columns) - set(rows.columns)):
        raise ValueError(f"no such columns: {sorted(missing)}")
    return rows.drop(*(c for c in columns if c in rows.columns)) if not any("." in c for c in columns) else rows.select(*(F.col(f"`{c}`") for c in rows.columns if c not in columns))
