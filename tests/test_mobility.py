import json
import time
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramlake.functions import geo
from tramlake.plans import gtfs, identify, positions, rail, segments, stops, trajectories
from tramlake.sources import archives

LINES = [
    ("1", "City", json.dumps([{"id": "30", "order": 3}, {"id": "10", "order": 1}, {"id": "20F", "order": 2}, {"id": "99", "order": 4}])),
    ("1", "Suburb", json.dumps([{"id": "30", "order": 1}, {"id": "10", "order": 2}])),
]
DETAILS = [
    ("10", '{"latitude": 50.0, "longitude": 4.0}', '{"fr": "Dix", "nl": "Tien"}'), ("20", '{"latitude": 50.0, "longitude": 4.02}', '{"nl": "Twintig"}'),
    ("30", '{"latitude": 50.01, "longitude": 4.02}', "{}"), ("99", "{}", '{"fr": "Sans"}'), ("10", '{"latitude": 50.0, "longitude": 4.001}', '{"fr": "Dix bis"}'),
]
CORNER = [{"x": 4.0, "y": 50.0}, {"x": 4.01, "y": 50.0}, {"x": 4.02, "y": 50.0}, {"x": 4.02, "y": 50.02}]
LINE = "array<struct<x:double,y:double>>"


@pytest.fixture(scope="module")
def net(spark):
    found = stops.stops(spark.createDataFrame(LINES, "lineid string, direction string, points string"), spark.createDataFrame(DETAILS, "id string, gpscoordinates string, name string").coalesce(1))
    shapes = spark.createDataFrame([("001b", 1, "#111111", CORNER[::-1]), ("001b", 2, "#222222", CORNER), ("001b", 2, "#333333", CORNER[:2])], f"ligne string, variante int, color_hex string, geometry {LINE}").coalesce(1)
    return found.cache(), shapes, segments.segments(shapes, found).cache()


def test_stops(net):
    got = [(r.direction_id, r.direction, r.stop_id, r.stop_name, r.stop_sequence, r.stop_lon) for r in net[0].orderBy("direction", "stop_sequence").collect()]
    assert got == [("V", 0, 10, "Dix bis", 1, 4.001), ("V", 0, 20, "Twintig", 2, 4.02), ("V", 0, 30, "", 3, 4.02), ("F", 1, 30, "", 1, 4.02), ("F", 1, 10, "Dix bis", 2, 4.001)]


def test_segments(net):
    got = {(r.direction, r.start, r.end): r for r in net[2].collect()}
    assert set(got) == {(1, 10, 20), (1, 20, 30), (2, 30, 10)}
    # Direction 1 takes the first shape of the other variant, stops become its vertices.
    assert [(round(p.x, 6), round(p.y, 6)) for p in got[1, 10, 20].geometry] == [(4.001, 50.0), (4.01, 50.0), (4.02, 50.0)]
    assert [(round(p.x, 6), round(p.y, 6)) for p in got[1, 20, 30].geometry][-1] == (4.02, 50.01)
    assert got[1, 10, 20].color == "#222222" and got[2, 30, 10].color == "#111111"
    assert 60 < got[1, 10, 20].distance < 80 and 1400 < got[1, 20, 30].distance < 1450


LIVE = [
    (1, "10", "1", "30", 0), (2, "10", "1.0", "30", 358), (3, "20F", "1", "77", 100), (4, "30", "1", "77", 0), (5, "7100", "1", "30", 0), (6, "10", "", "30", 0), (7, "55", "1", "30", 0), (8, "30", "1", "30", 0),
]


@pytest.mark.parametrize("compat", [False, True])
def test_positions(spark, net, compat):
    live = spark.createDataFrame(LIVE, "vehicle long, pointId string, lineId string, directionId string, distanceFromPoint int")
    got = {r.vehicle: r for r in positions.positions(live, net[2], net[0], compat=compat).collect()}
    # 3: at a stop of one direction; 4: at a stop of both; 5: depot; 6: no line; 7: unknown stop.
    assert {k: v.confidence_score for k, v in got.items()} == {1: 5, 2: 5, 3: 4, 8: 1}
    assert (got[1].geometry.x, got[1].direction, got[1].color, got[1].pointId) == (4.001, 1, "#222222", 10)
    x = got[2].geometry.x
    assert x == pytest.approx(4.02) if compat else abs(x - 4.006) < 1e-4
    assert (got[8].geometry.x, got[8].geometry.y) == (4.02, 50.01)


def test_student_quantile():
    for p, df, want in ((0.875, 1, 2.414214), (0.875, 2, 1.603567), (0.875, 5, 1.300949), (0.875, 30, 1.173065), (0.975, 10, 2.228139)):
        assert identify.student_quantile(p, df) == pytest.approx(want, abs=2e-5)


def vehicles(gap=None):
    """Two vehicles 2 km apart, a fix every 20 s at 10 m/s."""
    rows = [(v * 100 + k, "71", 1, 1000.0 + 20 * k + (gap or 0) * (k >= 3), 2000.0 * v + 200.0 * k, None, v) for v in (0, 1) for k in range(6)]
    return rows


def identified(spark, rows, **options):
    df = spark.createDataFrame([r[:6] for r in rows], "row_id long, lineId string, direction int, timestamp double, distance double, uuid string")
    got = {r.row_id: r.uuid for r in identify.identify(df, **options).collect()}
    assert set(got) == {r[0] for r in rows}
    trips = {}
    for r in rows:
        trips.setdefault(got[r[0]], []).append(r)
    for trip in trips.values():
        at = sorted(x[3] for x in trip)
        assert all(a < b for a, b in zip(at, at[1:], strict=False))
    return got, trips


def test_two_vehicles_are_told_apart(spark):
    got, trips = identified(spark, vehicles())
    assert sorted(sorted(r[0] for r in t) for t in trips.values()) == [[k for k in range(6)], [100 + k for k in range(6)]]
    assert identified(spark, vehicles()[::-1])[0] == got


def test_a_long_gap_parts_unless_on_the_line(spark):
    # After 380 seconds it is 200 metres on, far behind where the first trip's straight line leads.
    _, trips = identified(spark, [r for r in vehicles(gap=360) if r[6] == 0])
    assert sorted(map(len, trips.values())) == [3, 3]
    far = [(*r[:4], r[4] + 9000 * (r[0] >= 3), None, 0) for r in vehicles(gap=3600) if r[6] == 0]
    assert len(identified(spark, far)[1]) == 2


def slow_match(line, rows, known):
    """Trips as lists of row numbers by the rules, all pairs of trip and open row tried anew at each step."""
    t0, d0 = min(r[0] for r in rows), min(r[1] for r in rows)
    dt, dd = max(r[0] for r in rows) - t0, max(r[1] for r in rows) - d0
    at = [((t - t0) / dt if dt else 0.0, (d - d0) / dd if dd else 0.0) for t, d in rows]
    cap = 250 if line in ("1", "2", "5", "6") else 60 if line in ("7", "81") else 80
    trips = [[i for i, k in enumerate(known) if k == name] for name in dict.fromkeys(k for k in known if k)]
    left = [i for i, k in enumerate(known) if k is None]
    if not trips:
        trips = [[i] for i in left if at[i][0] == 0]
        left = [i for i in left if at[i][0] != 0]
    while left:
        best = None
        for k, trip in enumerate(trips):
            t, d = at[trip[-1]]
            stale = len(trip) >= 5 and (d - at[trip[0]][1]) * dd < 0
            for i in left:
                later, further = at[i][0] - t, at[i][1] - d
                seconds, metres = later * dt, further * dd
                if later > 0 and seconds <= t + 300 and further >= -40 / (dd or 1) and metres / seconds <= cap:
                    found = ((abs(further) + later) * (2 if stale else 1), i, k)
                    best = min(best or found, found)
        if best is None:
            trips.append([left.pop(0)])
        else:
            trips[best[2]].append(best[1])
            left.remove(best[1])
    return trips


def test_matching_against_all_pairs():
    rng = np.random.default_rng(8)
    for n in range(150):
        size, line = int(rng.integers(1, 26)), ["1", "7", "48"][n % 3]
        rows = sorted((float(20 * rng.integers(0, 12)), float(rng.integers(0, 3000))) for _ in range(size))
        known = [f"v{rng.integers(0, 3)}" if n % 2 and rng.random() < 0.3 else None for _ in rows]
        group = identify.Group(line, np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), known)
        group.match()
        assert group.trips == slow_match(line, rows, known), (line, rows, known)


def test_known_vehicles_go_on(spark):
    rows = [(*r[:5], f"v{r[6]}" if r[0] % 100 < 3 else None, r[6]) for r in vehicles()]
    got, _ = identified(spark, rows)
    assert all(got[r[0]] == f"v{r[6]}" for r in rows)


def test_random_observations_keep_the_rules(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "N08", 2, float(20 * rng.integers(0, 30)), float(rng.integers(0, 8000)), None, 0) for k in range(120)]
    identified(spark, rows)
    identified(spark, rows, compat=True)


def test_small_groups_share_batches_and_tasks(spark):
    # Before, each group was a data frame of its own, and all of them went to one task.
    df = spark.range(10_000).selectExpr("id AS row_id", "string(id % 4000) AS lineId", "int(id % 2) AS direction", "double(id) AS timestamp", "double(id % 700) AS distance", "string(null) AS uuid")
    found = identify.identify(df, seconds=86400.0)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    began = time.perf_counter()
    # Those of a line are 4,000 seconds apart.
    assert found.select("uuid").distinct().count() == 10_000
    assert time.perf_counter() - began < 15


def test_groups_over_several_batches(spark):
    rng = np.random.default_rng(4)
    lines = [None, "7", "48", "81"]
    rows = [(k, lines[k % 7 % 4], [1, 2, None][k % 3], float(20 * rng.integers(0, 60)), float(rng.integers(0, 3000)), None) for k in range(400)]
    df = spark.createDataFrame(rows, "row_id long, lineId string, direction int, timestamp double, distance double, uuid string")
    want = sorted(map(str, identify.identify(df).collect()))
    for size in (1, 7, 100):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert sorted(map(str, identify.identify(df).collect())) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(want) == 400


def test_a_long_group_looks_minutes_ahead():
    # Each step scored all rows anew for every trip before.
    at = np.repeat(400.0 * np.arange(1500), 4)
    group = identify.Group("48", at, np.tile([0.0, 0.0, 500.0, 900.0], 1500), [None] * 6000)
    began = time.perf_counter()
    group.match()
    assert sorted(i for trip in group.trips for i in trip) == list(range(6000)) and len(group.trips) == 6000
    assert time.perf_counter() - began < 5


def test_identified_positions_with_state(spark, net):
    at = lambda k, v: {"x": 4.0 + 0.002 * k + 0.0005 * v, "y": 50.0}
    rows = [(10, "1", 1, 0.0, "#222222", at(k, 0), 1000.0 + 20 * k) for k in range(5)]
    df = spark.createDataFrame(rows, "pointId long, lineId string, direction int, distanceFromPoint double, color string, geometry struct<x:double,y:double>, timestamp double")
    first = identify.identified(df.where("timestamp < 1060"), net[1])
    assert first.select("uuid").distinct().count() == 1 and set(df.columns) | {"uuid", "id"} == set(first.columns)
    later = identify.identified(df.where("timestamp >= 1060"), net[1], first.cache())
    assert later.count() == 2 and {r.uuid for r in later.collect()} == {r.uuid for r in first.collect()}


@pytest.fixture(scope="module")
def feed(spark):
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "stops": table([("a", "Alpha (A)", 50.0, 4.0), ("b", "Beta Sud", 50.1, 4.1), ("c", "Gamma", 50.2, 4.2)], "stop_id string, stop_name string, stop_lat double, stop_lon double"),
        "trips": table([("t1", "wd", "r", "Gamma", "x1"), ("t2", "wd", "r", "Alpha", "x2"), ("t3", "sun", "r", "Never", "x3")], "trip_id string, service_id string, route_id string, trip_headsign string, trip_short_name string"),
        "stop_times": table([
            ("t1", "a", 1, "08:00:00", "08:00:00"), ("t1", "b", 2, "08:10:00", "08:11:00"), ("t1", "c", 3, "08:20:00", "08:20:00"), ("t2", "c", 1, "23:50:00", "23:50:00"), ("t2", "a", 3, "24:10:00", "24:10:00"), ("t3", "a", 1, "08:05:00", "08:05:00"),
        ], "trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string"),
        "calendar": table([("wd", *"1111100", "20240101", "20241231"), ("sun", *"0000001", "20240101", "20241231")], "service_id string, monday string, tuesday string, wednesday string, thursday string, friday string, saturday string, sunday string, start_date string, end_date string"),
        "calendar_dates": table([("sun", "20240103", "1"), ("wd", "20240104", "2")], "service_id string, date string, exception_type string"),
    }


def test_services(feed):
    on = lambda d: sorted(r.service_id for r in gtfs.active_services(feed["calendar"], feed["calendar_dates"], d).collect())
    assert on(date(2024, 1, 2)) == ["wd"] and on(date(2024, 1, 3)) == ["sun", "wd"] and on(date(2024, 1, 4)) == [] and on(date(2024, 1, 7)) == ["sun"] and on(date(2025, 1, 7)) == []
    assert {r.trip_id for r in gtfs.on_date(feed, date(2024, 1, 2))["trips"].collect()} == {"t1", "t2"}


def epoch(*args):
    from zoneinfo import ZoneInfo

    return int(datetime(*args, tzinfo=ZoneInfo(gtfs.ZONE)).timestamp())


def test_schedule(feed):
    got = {r.stop_id: r for r in gtfs.schedule(feed, epoch(2024, 1, 2, 8, 5), epoch(2024, 1, 2, 8, 30)).collect()}
    assert {k: [(e.trip_id, e.arrival_time, e.departure_time, e.trip_headsign) for e in r.schedule] for k, r in got.items()} == {
        "b": [("t1", "08:10:00", "08:11:00", "Gamma")], "c": [("t1", "08:20:00", "08:20:00", "Gamma")],
    }
    assert got["b"].geometry.x == 4.1 and got["b"].stop_name == "Beta Sud"
    night = gtfs.schedule(feed, epoch(2024, 1, 1, 23, 0), epoch(2024, 1, 2, 8, 5)).collect()
    assert sorted((r.stop_id, e.trip_id) for r in night for e in r.schedule) == [("a", "t1"), ("c", "t2")]


def test_rail_positions(spark, feed):
    lines = spark.createDataFrame([("1", "2", [{"x": 4.0, "y": 50.0}, {"x": 4.1, "y": 50.1}]), ("2", "3", None)], f"stationfrom_id string, stationto_id string, geometry {LINE}")
    points = spark.createDataFrame([("1", "Alpha", "ALPHA"), ("2", "Beta-S", "Beta Sud"), ("3", "Gamma", "Gamma")], "ptcarid string, longnamefrench string, commerciallongnamefrench string")
    at = datetime(2024, 1, 2, 8, 5)
    got = rail.positions(feed, lines, points, at).collect()
    assert [(r.trip_id, r.trip_headsign, r.name_start, r.name_end) for r in got] == [("t1", "Gamma", "ALPHA", "BETASUD")]
    assert (got[0].geometry.x, got[0].geometry.y) == (pytest.approx(4.05), pytest.approx(50.05))
    assert rail.positions(feed, lines, points, at, compat=True).count() == 0
    late = spark.createDataFrame([("t1", 150)], "trip_id string, arrival_delay int")
    assert rail.positions(feed, lines, points, at, late).first().geometry.x == pytest.approx(4.025)
    assert rail.positions(feed, lines, points, datetime(2024, 1, 2, 8, 0)).count() == 0


def snapshot(k, *vehicles):
    features = [{"type": "Feature", "id": v, "properties": {"uuid": v, "lineId": "1", "pointId": k}, "geometry": {"type": "Point", "coordinates": [4.0 + k, 50.0]}} for v in vehicles]
    return datetime(2024, 1, 1) + timedelta(minutes=10 * k), json.dumps({"type": "FeatureCollection", "features": features})


FEATURES = "array<struct<properties:struct<uuid:string,lineId:string,pointId:int>,geometry:struct<coordinates:array<double>>>>"


def test_trajectories(spark):
    rows = spark.createDataFrame([snapshot(0, "a"), snapshot(1, "a", "b"), snapshot(2, "a"), snapshot(3, "c"), snapshot(4)], "date timestamp_ntz, data string")
    start = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds()) - 1
    got = trajectories.trajectories(rows, FEATURES, "uuid", start, drop=["pointId"])
    assert json.loads(trajectories.collection(got).first().value) == {"type": "FeatureCollection", "features": [{
        "type": "Feature", "properties": {"uuid": "a", "lineId": "1"},
        "temporalGeometry": {"type": "MovingPoint", "coordinates": [[4.0, 50.0], [5.0, 50.0], [6.0, 50.0]], "datetimes": [f"2024-01-01T00:{m}0:00.000000Z" for m in "012"]},
    }]}
    assert trajectories.trajectories(rows, FEATURES, "uuid", start + 1200).count() == 0
    assert json.loads(trajectories.collection(got.limit(0)).first().value)["features"] == []


def test_trips_of_vehicles_and_trains(spark):
    start = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds()) - 1
    rows = spark.createDataFrame([snapshot(0, "a"), snapshot(1, "a")], "date timestamp_ntz, data string")
    assert set(json.loads(trajectories.vehicle_trips(rows, start).first().feature)["properties"]) <= {"uuid", "lineId", "direction", "color"}
    trains = rows.withColumn("data", F.regexp_replace("data", '"uuid"', '"trip_id"'))
    assert trajectories.train_trips(trains, start).first().trip_id == "a"


def test_spans():
    hour = timedelta(hours=1)
    assert trajectories.span(0, None) == (datetime(1970, 1, 1), datetime(1970, 1, 1) + hour) and trajectories.span(None, 7200) == (datetime(1970, 1, 1) + hour, datetime(1970, 1, 1) + 2 * hour)
    now = datetime(2024, 1, 1)
    assert trajectories.span(None, None, now) == (now - hour, now)


def test_temporal_properties(spark):
    rows = spark.createDataFrame([("a", "t2", 2.0, 7), ("a", "t1", 1.0, 7)], "id string, t string, v double, s int").withColumn("geometry", geo.point(F.col("v"), F.lit(0.0)))
    got = json.loads(trajectories.mf_json(rows, "id", "t", static=["s"], temporal=["v"], fields={"v": {"uom": "m"}}, interpolation="Linear", crs={"type": "Name"}).first().feature)
    assert got["temporalProperties"] == [{"datetimes": ["t1", "t2"], "v": {"values": [1.0, 2.0], "uom": "m"}}]
    assert got["temporalGeometry"]["interpolation"] == "Linear" and got["crs"] == {"type": "Name"} and got["properties"] == {"id": "a", "s": 7}


def test_feed_from_zip(spark, feed, tmp_path):
    import io
    import zipfile

    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("stops.txt", '﻿stop_id,stop_name,stop_lat,stop_lon\r\na,"Al, pha",50.0,4.0\r\nb,Beta,,4.1\r\n')
        z.writestr("stop_times.txt", "trip_id,stop_id,stop_sequence,arrival_time,departure_time\nt1,a,1,25:00:00,25:00:00\n")
        z.writestr("other.bin", b"\xff\xfe")
    files = spark.createDataFrame([(bytearray(data.getvalue()),), (bytearray(b"no zip"),)], "content binary")
    got = archives.gtfs_from_zip(files)
    assert [tuple(r) for r in got["stops"].orderBy("stop_id").collect()] == [("a", "Al, pha", 50.0, 4.0), ("b", "Beta", None, 4.1)]
    kept = spark.createDataFrame([(datetime(2024, 1, 2), bytearray(data.getvalue()))], "date timestamp_ntz, data binary").select("date", F.base64("data").alias("data"))
    assert gtfs.schedule_at(kept, epoch(2024, 1, 1, 8), epoch(2024, 1, 1, 9)) is None
    feeds = gtfs.Feeds(spark, str(tmp_path / "feeds"))
    first, again = feeds.tables(kept), feeds.tables(kept)
    assert first.keys() == again.keys() == got.keys() and [r.stop_name for r in again["stops"].orderBy("stop_id").collect()] == ["Al, pha", "Beta"]
    assert len(feeds.known) == len([*(tmp_path / "feeds").iterdir()]) == 1 and gtfs.Feeds(spark, str(tmp_path / "late"), seconds=0.0).tables(kept) is None
    archives.gtfs_to_parquet(got, str(tmp_path / "feed"))
    assert archives.gtfs_from_parquet(spark, str(tmp_path / "feed"), ["stop_times"])["stop_times"].first().stop_sequence == 1
    assert archives.zip_maps(files.limit(1)).first().members["other.bin"] is None
