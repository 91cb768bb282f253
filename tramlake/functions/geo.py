"""Planar geometry and the Belgian Lambert 72 projection as column expressions.

A point is a struct of x and y (longitude, latitude, or metres), a line an array of points. Nothing here leaves the JVM.
"""

from __future__ import annotations

from math import cos, log, pi, radians, sin, sqrt, tan

from pyspark.sql import Column, functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def in_box(p: Column, west: float, south: float, east: float, north: float) -> Column:
    return p["x"].between(west, east) & p["y"].between(south, north)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def segments(line: Column) -> Column:
    """Neighbouring vertices as an array of (a, b)."""
    return _let(line, lambda v: F.transform(F.slice(v, F.lit(2), F.size(v)), lambda b, i: F.struct(v[i].alias("a"), b.alias("b"))))


def length(line: Column) -> Column:
    return F.aggregate(segments(line), F.lit(0.0), lambda s, e: s + distance(e["a"], e["b"]))


def share_on_segment(p: Column, a: Column, b: Column) -> Column:
    """Where on a segment, 0 to 1, the point nearest to p is."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    square = dx * dx + dy * dy
    return F.when(square == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / square)))


def along(a: Column, b: Column, share: Column) -> Column:
    return F.struct((a["x"] + (b["x"] - a["x"]) * share).alias("x"), (a["y"] + (b["y"] - a["y"]) * share).alias("y"))


def nearest(line: Column, p: Column) -> Column:
    """struct(far, travelled, segment, at): distance of p from the line, distance along it, number of the nearest segment (from 0; the first
    of equally near ones) and the nearest point."""
    none = F.struct(F.lit(float("inf")).alias("far"), F.lit(0.0).alias("travelled"), F.lit(-1).alias("segment"), line[0].alias("at"))
    start = F.struct(none.alias("best"), F.lit(0.0).alias("passed"), F.lit(0).alias("n"))

    def step(s: Column, e: Column) -> Column:
        def seen(m: Column) -> Column:
            found = F.struct(distance(p, m["at"]).alias("far"), (s["passed"] + m["share"] * m["size"]).alias("travelled"), s["n"].alias("segment"), m["at"].alias("at"))
            best = _let(found, lambda x: F.when(x["far"] < s["best"]["far"], x).otherwise(s["best"]))
            return F.struct(best.alias("best"), (s["passed"] + m["size"]).alias("passed"), (s["n"] + 1).alias("n"))

        placed = lambda share: F.struct(share.alias("share"), along(e["a"], e["b"], share).alias("at"), distance(e["a"], e["b"]).alias("size"))
        return _let(_let(share_on_segment(p, e["a"], e["b"]), placed), seen)

    return F.aggregate(segments(line), start, step)["best"]


def project(line: Column, p: Column) -> Column:
    """Distance along the line of the point nearest to p."""
    return nearest(line, p)["travelled"]


def interpolate(line: Column, travelled: Column, normalised: bool = False) -> Column:
    """The point at a distance along the line (or a share of its length); negative distances count from the end, beyond
    either end is that end."""
    whole = length(line)
    asked = travelled * whole if normalised else travelled
    goal = F.greatest(F.lit(0.0), F.when(asked < 0, whole + asked).otherwise(asked))
    start = F.struct(F.lit(0.0).alias("passed"), F.lit(False).alias("found"), line[0].alias("at"))

    def walk(goal: Column) -> Column:
        def step(s: Column, e: Column) -> Column:
            size = distance(e["a"], e["b"])
            here = (~s["found"]) & (s["passed"] + size >= goal)
            share = F.when(size == 0, F.lit(0.0)).otherwise((goal - s["passed"]) / size)
            at = F.when(here, along(e["a"], e["b"], share)).when(s["found"], s["at"]).otherwise(e["b"])
            return F.struct((s["passed"] + size).alias("passed"), (s["found"] | here).alias("found"), at.alias("at"))

        return F.aggregate(segments(line), start, step)["at"]

    return _let(goal, walk)


def insert_vertex(line: Column, p: Column) -> Column:
    """The line with the point nearest to p as a vertex more."""
    return _let(nearest(line, p), lambda n: F.concat(F.slice(line, F.lit(1), n["segment"] + 1), F.array(n["at"]), F.slice(line, n["segment"] + 2, F.size(line))))


def part(line: Column, start: Column, end: Column) -> Column:
    """The line from one distance along it to another, its vertices between them included; null where the end does not come later."""
    kept = F.aggregate(
        segments(line), F.struct(F.lit(0.0).alias("passed"), F.array().cast("array<struct<x:double,y:double>>").alias("kept")),
        lambda s, e: F.struct(
            (s["passed"] + distance(e["a"], e["b"])).alias("passed"),
            F.when((s["passed"] + distance(e["a"], e["b"]) > start) & (s["passed"] + distance(e["a"], e["b"]) < end), F.concat(s["kept"], F.array(e["b"]))).otherwise(s["kept"]).alias("kept"),
        ),
    )["kept"]
    return F.when(end > start, F.concat(F.array(interpolate(line, start)), kept, F.array(interpolate(line, end))))


# EPSG 31370 (Belgian Lambert 72), its ellipsoid (International 1924) and its shift to WGS 84.
A_BE, F_BE = 6378388.0, 1 / 297
A_84, F_84 = 6378137.0, 1 / 298.257223563
LON_0, LAT_1, LAT_2 = 4.367486666666666, 51.16666723333333, 49.8333339
X_0, Y_0 = 150000.013, 5400088.438
SHIFT, TURN, SCALE = (-106.8686, 52.2978, -103.7239), (0.3366, -0.457, 1.8422), -1.2747


def _cone() -> tuple[float, float, float]:
    e = sqrt(F_BE * (2 - F_BE))
    m = lambda p: cos(p) / sqrt(1 - (e * sin(p)) ** 2)
    t = lambda p: tan(pi / 4 - p / 2) / ((1 - e * sin(p)) / (1 + e * sin(p))) ** (e / 2)
    p, q = radians(LAT_1), radians(LAT_2)
    n = (log(m(p)) - log(m(q))) / (log(t(p)) - log(t(q)))
    return e, n, A_BE * m(p) / (n * t(p) ** n)


def _turned(sign: int) -> str:
    """SQL of the datum shift between geocentric coordinates gx, gy, gz; sign 1: towards WGS 84."""
    rx, ry, rz = (radians(x / 3600) * sign for x in TURN)
    k = 1 + sign * SCALE * 1e-6
    dx, dy, dz = (sign * x for x in SHIFT)
    return f"{k!r} * (gx - {rz!r} * gy + {ry!r} * gz) + {dx!r} AS hx, {k!r} * ({rz!r} * gx + gy - {rx!r} * gz) + {dy!r} AS hy, {k!r} * (-({ry!r}) * gx + {rx!r} * gy + gz) + {dz!r} AS hz"


def _geocentric(lon: str, lat: str, a: float, f: float) -> str:
    e2 = f * (2 - f)
    n = f"({a!r} / sqrt(1 - {e2!r} * sin({lat}) * sin({lat})))"
    return f"{n} * cos({lat}) * cos({lon}) AS gx, {n} * cos({lat}) * sin({lon}) AS gy, {n} * {1 - e2!r} * sin({lat}) AS gz"


def _geodetic(a: float, f: float) -> str:
    """SQL of longitude and latitude in radians from hx, hy, hz (Bowring)."""
    e2, b = f * (2 - f), a * (1 - f)
    p = "sqrt(hx * hx + hy * hy)"
    u = f"atan2(hz * {a!r}, {p} * {b!r})"
    up = e2 / (1 - e2) * b
    return f"atan2(hy, hx) AS lon, atan2(hz + {up!r} * pow(sin({u}), 3), {p} - {e2 * a!r} * pow(cos({u}), 3)) AS lat"


def lambert_steps(source: str, x: str = "x", y: str = "y") -> str:
    """SQL that adds lambert_x and lambert_y to the rows of `source` with WGS 84 degrees x and y; any engine can run it."""
    e, n, scale = _cone()
    t = f"(tan({pi / 4!r} - lat / 2) / pow((1 - {e!r} * sin(lat)) / (1 + {e!r} * sin(lat)), {e / 2!r}))"
    rho, theta = f"({scale!r} * pow({t}, {n!r}))", f"({n!r} * (lon - {radians(LON_0)!r}))"
    return f"""SELECT * EXCEPT (rlon, rlat, gx, gy, gz, hx, hy, hz, lon, lat), {X_0!r} + {rho} * sin({theta}) AS lambert_x, {Y_0!r} - {rho} * cos({theta}) AS lambert_y FROM (
      SELECT *, {_geodetic(A_BE, F_BE)} FROM (
        SELECT *, {_turned(-1)} FROM (
          SELECT *, {_geocentric('rlon', 'rlat', A_84, F_84)} FROM (SELECT *, radians({x}) AS rlon, radians({y}) AS rlat FROM {source}))))"""


def to_lambert(p: Column) -> Column:
    """A point in degrees (WGS 84) to metres (Lambert 72)."""
    return _chain(p, forward=True)


def to_degrees(p: Column) -> Column:
    """A point in metres (Lambert 72) to degrees (WGS 84)."""
    return _chain(p, forward=False)


def _chain(p: Column, forward: bool) -> Column:
    e, n, scale = _cone()
    num = F.lit

    def geocentric(lon, lat, a, f):
        e2 = f * (2 - f)
        big = num(a) / F.sqrt(1 - num(e2) * F.sin(lat) * F.sin(lat))
        return F.struct((big * F.cos(lat) * F.cos(lon)).alias("x"), (big * F.cos(lat) * F.sin(lon)).alias("y"), (big * num(1 - e2) * F.sin(lat)).alias("z"))

    def turned(g, sign):
        rx, ry, rz = (radians(v / 3600) * sign for v in TURN)
        k, (dx, dy, dz) = 1 + sign * SCALE * 1e-6, (sign * v for v in SHIFT)
        return F.struct(
            (k * (g["x"] - rz * g["y"] + ry * g["z"]) + dx).alias("x"), (k * (rz * g["x"] + g["y"] - rx * g["z"]) + dy).alias("y"), (k * (-ry * g["x"] + rx * g["y"] + g["z"]) + dz).alias("z"),
        )

    def geodetic(h, a, f):
        e2, b = f * (2 - f), a * (1 - f)
        flat = F.sqrt(h["x"] * h["x"] + h["y"] * h["y"])
        u = F.atan2(h["z"] * a, flat * b)
        return F.struct(F.atan2(h["y"], h["x"]).alias("lon"), F.atan2(h["z"] + e2 / (1 - e2) * b * F.pow(F.sin(u), 3), flat - e2 * a * F.pow(F.cos(u), 3)).alias("lat"))

    if forward:
        def cone(g):
            t = F.tan(num(pi / 4) - g["lat"] / 2) / F.pow((1 - e * F.sin(g["lat"])) / (1 + e * F.sin(g["lat"])), num(e / 2))
            rho, theta = scale * F.pow(t, num(n)), n * (g["lon"] - radians(LON_0))
            return _let(F.struct(rho.alias("r"), theta.alias("t")), lambda c: F.struct((X_0 + c["r"] * F.sin(c["t"])).alias("x"), (Y_0 - c["r"] * F.cos(c["t"])).alias("y")))

        start = geocentric(F.radians(p["x"]), F.radians(p["y"]), A_84, F_84)
        return _let(start, lambda g: _let(turned(g, -1), lambda h: _let(geodetic(h, A_BE, F_BE), cone)))

    def uncone(q):
        rho = F.sqrt((q["x"] - X_0) * (q["x"] - X_0) + (Y_0 - q["y"]) * (Y_0 - q["y"]))
        t = F.pow(rho / scale, num(1 / n))
        lon = F.atan2(q["x"] - X_0, Y_0 - q["y"]) / n + radians(LON_0)

        def better(lat):
            return num(pi / 2) - 2 * F.atan(t * F.pow((1 - e * F.sin(lat)) / (1 + e * F.sin(lat)), num(e / 2)))

        lat = F.aggregate(F.sequence(F.lit(1), F.lit(6)), num(pi / 2) - 2 * F.atan(t), lambda s, _: better(s))
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    def degrees(g):
        return F.struct(F.degrees(g["lon"]).alias("x"), F.degrees(g["lat"]).alias("y"))

    return _let(uncone(p), lambda g: _let(geocentric(g["lon"], g["lat"], A_BE, F_BE), lambda c: _let(turned(c, 1), lambda h: _let(geodetic(h, A_84, F_84), degrees))))
