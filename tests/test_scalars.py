from datetime import datetime, timedelta

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from tramlake.functions import geo, text, time
from tramlake.functions.numbers import rounded


def values(spark, f, *given):
    rows = [(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(given)]
    df = spark.createDataFrame(rows, ["k", *(f"c{i}" for i in range(len(rows[0]) - 1))])
    return [r.x for r in df.orderBy("k").select(f(*(F.col(c) for c in df.columns[1:])).alias("x")).collect()]


@pytest.mark.parametrize(("f", "given", "want"), [
    (text.gtfs_line_number, ["N08", "071", "T92", "5", "06M"], [208, 71, 92, 5, 6]),
    (text.generic_line, ["071b", "T92", "N8", "0"], ["71", "92", "N8", ""]),
    (text.shape_line_number, ["071b", "004t"], [71, 4]),
    (text.shape_line_name, ["208b", "071b", "004t", "95"], ["N08", "71", "4", "95"]),
    (text.live_line_name, [" 10 ", "7.0", "T7", "100"], ["10", "7", "7", "100"]),
    (lambda c: text.live_line_name(c, True), ["10", "7.0", "T7", "100"], ["", "7", "7", "0"]),
    (text.live_stop_number, ["8021F", "1234", "G55"], [8021, 1234, 55]),
    (text.stop_number, ["12a", "Z", "", "0089F"], [12, 0, 0, 89]),
    (text.station_key, ["Sint-Job (b)", "l'Est du Nord"], ["SINT-JOB", "LESTDUNORD"]),
    (lambda c: text.member(c, "$.fr", "$.nl"), ['{"fr":"a","nl":"b"}', '{"nl":"b"}', "{}"], ["a", "b", ""]),
    (text.direction_letter, ["City", "Suburb"], ["V", "F"]), (text.direction_number, ["V", "F"], [1, 2]),
    (text.line_type, ["1", "92", "71", "N08"], ["metro", "tram", "bus", "bus"]), (text.max_speed, ["1", "92", "71"], [250, 60, 80]), (text.legal_limit, ["1", "92", "12", "71"], [50, 30, 100, 50]),
    (time.seconds_of_day, ["25:01:02", "00:00:09"], [90062, 9]), (time.clock, [90062, 59], ["01:01:02", "00:00:59"]),
    (lambda c: rounded(c, 2), [0.575, 0.125, 2.675], [0.57, 0.12, 2.68]),
])
def test_functions(spark, f, given, want):
    assert values(spark, f, *given) == want


def test_moment_of_a_service_day(spark):
    assert values(spark, time.moment_of, (1000, "24:00:01")) == [1000 + 86401]


def test_periods_and_schedules():
    assert time.period("20s") == timedelta(seconds=20) and time.period("1w") == timedelta(weeks=1)
    assert time.schedule("04:20") == {"at": (4, 20)} and time.schedule("15m") == {"every": timedelta(minutes=15)}
    for bad in ("", "5", "x", "1w", "25:00"):
        with pytest.raises(ValueError):
            time.schedule(bad)


@given(st.datetimes(datetime(1900, 1, 1), datetime(2100, 1, 1)), st.sampled_from(["20s", "7m", "1h", "1d", "1w"]))
def test_floor(moment, size):
    delta = time.period(size)
    floor = time.floor(moment, delta)
    assert floor <= moment < floor + delta and time.floor(floor, delta) == floor
    assert size != "1w" or floor.weekday() == 0 and floor.hour == 0


@pytest.mark.parametrize("size", ["20s", "7m", "1h", "1d", "1w"])
def test_bucket_is_floor(spark, size):
    moments = [datetime(2024, 2, 29, 23, 59, 59, 999999), datetime(2020, 1, 5, 0, 0), datetime(2021, 1, 4), datetime(1999, 12, 31, 7, 6, 5, 4), datetime(2024, 7, 1)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    got = {r.t: r.b for r in df.select("t", time.bucket(F.col("t"), time.period(size)).alias("b")).collect()}
    assert got == {m: time.floor(m, time.period(size)) for m in moments}


def xy(*points):
    return F.array(*(geo.point(F.lit(x), F.lit(y)) for x, y in points))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_geometry_by_hand(spark):
    line = xy((0, 0), (3, 0), (3, 4))
    assert one(spark, geo.length(line)) == 7
    assert [tuple(one(spark, geo.interpolate(line, F.lit(d)))) for d in (0.0, 1.5, 3.0, 5.0, 9.0, -1.0)] == [(0, 0), (1.5, 0), (3, 0), (3, 2), (3, 4), (3, 3)]
    assert tuple(one(spark, geo.interpolate(line, F.lit(0.5), True))) == (3, 0.5)
    p = geo.point(F.lit(4.0), F.lit(1.0))
    n = one(spark, geo.nearest(line, p))
    assert (n.far, n.travelled, n.segment, tuple(n["at"])) == (1, 4, 1, (3, 1))
    assert [tuple(v) for v in one(spark, geo.insert_vertex(line, p))] == [(0, 0), (3, 0), (3, 1), (3, 4)]
    assert [tuple(v) for v in one(spark, geo.part(line, F.lit(1.0), F.lit(5.0)))] == [(1, 0), (3, 0), (3, 2)]
    assert one(spark, geo.part(line, F.lit(5.0), F.lit(1.0))) is None
    assert one(spark, geo.length(xy((1, 1), (1, 1)))) == 0 and one(spark, geo.project(xy((1, 1), (1, 1)), p)) == 0
    assert one(spark, geo.in_box(p, 0, 0, 5, 5)) and not one(spark, geo.in_box(p, 0, 0, 3, 5))


def test_projection_and_interpolation_are_inverse(spark):
    line = xy((0, 0), (2, 1), (5, 1), (5, 7))
    df = spark.range(100).select((F.col("id") * 0.1).alias("d"))
    off = df.select(F.abs(geo.project(line, geo.interpolate(line, F.col("d"))) - F.least("d", geo.length(line))).alias("x"))
    assert off.agg(F.max("x")).first()[0] < 1e-9


def test_lambert(spark):
    # The projection's own origin on its axis, and a point in the capital's centre to some metres.
    p = one(spark, geo.to_lambert(geo.point(F.lit(4.3525), F.lit(50.8467))))
    assert abs(p.x - 148_900) < 150 and abs(p.y - 170_800) < 200
    grid = spark.range(400).select(geo.point(2.5 + F.col("id") % 20 * 0.2, 49.4 + F.floor(F.col("id") / 20) * 0.11).alias("p"))
    back = grid.select("p", geo.to_degrees(geo.to_lambert(F.col("p"))).alias("q"))
    # A centimetre is some 1e-7 degrees.
    assert back.agg(F.max(F.greatest(F.abs(F.col("p.x") - F.col("q.x")), F.abs(F.col("p.y") - F.col("q.y"))))).first()[0] < 1e-7
