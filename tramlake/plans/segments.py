"""The pieces of line shapes between neighbouring stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tramlake.functions import geo, text
from tramlake.functions.geo import _let
from tramlake.operators import matching


def nearest_vertex(line: Column, p: Column) -> Column:
    """Number (from 0) of the vertex nearest to p, the first of equally near ones."""
    return F.array_min(F.transform(line, lambda v, i: F.struct(geo.distance(v, p).alias("d"), i.alias("i"))))["i"]


def segments(shapes: DataFrame, stops: DataFrame) -> DataFrame:
    """shapes: ligne, variante, color_hex, geometry (in reading order); stops as stops() gives them.

    The first shape of the line whose variant is not the stops' direction gets every stop as a vertex; a segment runs from
    one stop's vertex to the next stop's. Its distance is that of its start along the whole shape, in metres.
    """
    named = shapes.select(text.shape_line_name(F.col("ligne")).alias("ligne"), "variante", "color_hex", F.col("geometry").alias("line"), F.monotonically_increasing_id().alias("__at"))
    stop = F.struct("stop_sequence", "place", "stop_id", "geometry")
    lists = stops.groupBy(F.col("route_short_name").alias("line_id"), (F.col("direction") + 1).alias("direction")).agg(F.array_sort(F.collect_list(stop)).alias("stops"))
    matched = matching.first_other(lists, named, {"line_id": "ligne"}, ("direction", "variante"), ["__at"]).where(F.col("line").isNotNull())
    woven = F.aggregate("stops", F.col("line"), lambda line, s: geo.insert_vertex(line, s["geometry"]))
    rows = matched.withColumn("woven", woven).withColumn("metric", F.transform("line", geo.to_lambert))

    def piece(s: Column, i: Column) -> Column:
        before = F.col("stops")[i]

        def cut(ends: Column) -> Column:
            first, last = nearest_vertex(F.col("woven"), ends["a"]), nearest_vertex(F.col("woven"), ends["b"])
            return _let(F.struct(first.alias("a"), last.alias("b")), lambda n: F.when(n["b"] > n["a"], F.slice("woven", n["a"] + 1, n["b"] - n["a"] + 1)))

        ends = F.struct(geo.nearest(F.col("woven"), before["geometry"])["at"].alias("a"), geo.nearest(F.col("woven"), s["geometry"])["at"].alias("b"))
        built = _let(ends, lambda e: F.struct(cut(e).alias("geometry"), geo.project(F.col("metric"), geo.to_lambert(e["a"])).alias("distance")))
        return F.struct(before["stop_id"].alias("start"), s["stop_id"].alias("end"), built.alias("p"))

    pieces = F.explode(F.transform(F.slice("stops", 2, F.size("stops")), piece)).alias("s")
    return rows.select("line_id", "direction", F.col("color_hex").alias("color"), pieces).where(F.col("s.p.geometry").isNotNull()).select(
        "line_id", "direction", F.col("s.p.geometry").alias("geometry"), F.col("s.start").alias("start"), F.col("s.p.distance").alias("distance"), F.col("s.end").alias("end"), "color",
    )
