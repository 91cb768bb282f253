import json
import threading
from datetime import datetime, timedelta
from urllib.error import HTTPError
from urllib.request import urlopen

import pytest
from pyspark.sql import functions as F

from tramlake.plans import compaction, nodes, service
from tramlake.plans.nodes import Node
from tramlake.sources.catalog import Catalog, blob_path, decoded
from tramlake.streaming import incremental, runner

T0 = datetime(2024, 1, 1)
H = timedelta(hours=1)


def rows(spark, *items):
    return spark.createDataFrame([*items], "date timestamp_ntz, data string")


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "catalog"))


def test_catalog_appends_and_reads(spark, catalog):
    catalog.create(["c", "d"])
    assert catalog.read("c").count() == 0 and catalog.last_date("c") is None and catalog.read("unknown").count() == 0
    catalog.append("c", rows(spark, (T0, "x"), (T0 + H, "y"), (T0 + 2 * H, "x"), (T0 + 3 * H, None)))
    catalog.append("c", rows(spark, (T0 + 4 * H, "y"), (T0 + 2 * H, "again"), (T0 + 30 * H, "z")))
    raw = {r.id: (r.date - T0, r.data, r.copy_id) for r in catalog.raw("c").collect()}
    # A row of a date that is there already is added like any other.
    assert raw == {1: (0 * H, "x", None), 2: (H, "y", None), 3: (2 * H, None, 1), 4: (3 * H, None, None), 5: (2 * H, "again", None), 6: (4 * H, None, 2), 7: (30 * H, "z", None)}
    data = lambda df: [r.data for r in df.collect()]
    assert sorted(data(catalog.between("c"))) == sorted(["x", "y", "x", "again", "y", "z"]) and data(catalog.latest("c")) == ["z"] and data(catalog.first("c")) == ["x"]
    assert sorted(data(catalog.before("c", T0 + 4 * H, 2))) == ["again", "x"] and data(catalog.after("c", T0 + 2 * H)) == ["z", "y"] and len(data(catalog.within("c", T0, T0 + 2 * H))) == 4
    assert catalog.read("c", with_null=True).count() == 7 and catalog.last_date("c") == T0 + 30 * H
    catalog.append("d", rows(spark, (T0, "x"), (T0 + H, "x")), "text", share=False)
    catalog.append("e", spark.createDataFrame([(T0, bytearray(b"\x00\xff")), (T0 + H, bytearray(b"\x00\xff"))], "date timestamp_ntz, data binary"), "gtfs")
    assert [bytes(r.payload) for r in decoded(catalog.read("e"), "gtfs").collect()] == [b"\x00\xff"] * 2
    assert [r.payload for r in decoded(catalog.raw("d"), "text").collect()] == ["x", "x"] and decoded(catalog.raw("d"), "json").count() == 0
    assert catalog.raw("d").select(blob_path("d", F.col("date")).alias("p")).orderBy("p").first().p == "d/2024-01-01_00-00-00"


def test_catalog_loses_no_row(spark, catalog):
    catalog.append("c", rows(spark, (T0, "a"), (T0, "b"), (T0, "a")))
    catalog.append("c", rows(spark, (T0, "c"), (T0, "a"), (None, "d"), (None, None), (T0 + H, None)))
    assert sorted((r.date, r.data) for r in catalog.read("c").where("date IS NOT NULL").collect()) == [(T0, x) for x in "aaabc"]
    assert sorted(r.id for r in catalog.raw("c").collect()) == list(range(1, 9)) and catalog.raw("c").where("date IS NULL").count() == 2
    assert [r.data for r in catalog.latest("c").collect()] in (["a"], ["b"], ["c"])


def test_reads_touch_the_days_between_their_times(spark, catalog):
    catalog.append("c", rows(spark, *((T0 + k * 24 * H, f"{k % 3}") for k in range(6))))
    found = catalog.between("c", T0 + 30 * H, T0 + 60 * H, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan and "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.data for r in found.collect()] == ["2"] and len({r.d for r in catalog.raw("c", T0 + 30 * H, T0 + 60 * H).selectExpr("to_date(date) AS d").collect()}) == 2


CONFIG = """
[[collectors]]
name = "raw"
schedule = "20s"
[[harvesters]]
name = "pairs"
run = "json:dumps"
source = "raw"
source_range = 2
dependencies = ["other.stops"]
optional_dependencies = ["pairs"]
optional_dependencies_limit = [10]
[harvesters.parquetize]
batch = "1h"
types = { pointId = "string" }
groups = [{ period = "1d" }, { period = "1w", keys = ["lineId"] }]
"""


def test_configuration(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "city.toml").write_text(CONFIG)
    (tmp_path / "deep" / "other.toml").write_text('[[collectors]]\nname = "stops"\n')
    found = nodes.load(str(tmp_path))
    pairs = found["city_pairs"]
    assert (pairs.source, pairs.dependencies, pairs.optional) == ("city_raw", [("other_stops", 1)], [("city_pairs", 10)])
    assert (pairs.strict, pairs.multiple, pairs.levels) == (True, False, [("1h", []), ("1d", []), ("1w", ["lineId"])]) and pairs.load() is json.dumps
    assert nodes.order(found).index("city_pairs") == 2
    assert len(nodes.selected(found, "collectors", ["*"])) == len(nodes.selected(found, "collectors", ["all"])) == 2
    with pytest.raises(ValueError):
        nodes.selected(found, "handlers", ["nope"])
    (tmp_path / "bad.toml").write_text('[[harvesters]]\nname = "x"\nsource = "gone"\n')
    with pytest.raises(ValueError):
        nodes.load(str(tmp_path))


def test_derive_slice_by_slice(spark, catalog):
    catalog.append("raw", rows(spark, *((T0 + k * H, f"{k}") for k in range(5))))
    seen = []

    def run(source, stops, out):
        got = sorted(r.data for r in source.collect())
        seen.append((got, [r.data for r in stops.collect()], None if out is None else [r.data for r in out.collect()]))
        return None if got == ["2", "3"] else source.agg(F.array_join(F.array_sort(F.collect_list("data")), "+").alias("data"))

    c = Node("out", "harvesters", run, source="raw", source_range=2, dependencies=[("stops", 1)], optional=[("out", 2)])
    assert not runner.derive(catalog, c) and runner.watermark(catalog, c) is None
    catalog.append("stops", rows(spark, (T0 + 3 * H, "late")))
    assert runner.watermark(catalog, c) == T0 + 3 * H - timedelta(seconds=1)
    catalog.append("stops", rows(spark, (T0 - H, "early")))
    assert runner.derive_all(catalog, c) == 2
    assert seen == [(["0", "1"], ["early"], None), (["2", "3"], ["early"], ["0+1"])]
    assert [(r.date, r.data) for r in catalog.raw("out").orderBy("date").collect()] == [(T0 + H, "0+1"), (T0 + 3 * H, None)]
    c.strict = False
    assert runner.derive_all(catalog, c) == 1 and seen[-1] == (["4"], ["late"], ["0+1"])


def test_several_results_keep_their_dates(spark, catalog):
    catalog.append("raw", rows(spark, *((T0 + k * H, f"{k}") for k in range(4))))
    c = Node("out", "harvesters", lambda source: source.where("data <> '1'").select("date", F.concat(F.lit("r"), "data").alias("data")), source="raw", source_range=2, multiple=True)
    assert runner.derive_all(catalog, c) == 2
    assert [(r.date - T0, r.data) for r in catalog.between("out").collect()] == [(0 * H, "r0"), (2 * H, "r2"), (3 * H, "r3")]


def test_period_slices(spark):
    source = rows(spark, *((T0 + k * H / 2, f"{k}") for k in range(6)))
    assert [r.data for r in incremental.next_slice(source, T0, "1h", now=T0 + H).orderBy("date").collect()] == ["0", "1"]
    assert incremental.next_slice(source, T0 + 2 * H, "1h") is None


def test_collect_and_loops(spark, catalog):
    assert runner.collect(catalog, Node("c", "collectors", lambda: "v"), T0) and not runner.collect(catalog, Node("c", "collectors", lambda: None), T0 + H)
    assert catalog.read("c").count() == 1
    steps, slept = iter([True, False, ValueError(), True]), []

    def step():
        x = next(steps)
        if isinstance(x, Exception):
            raise x
        return x

    stops = iter([False] * 4 + [True])
    runner.loop(step, lambda: next(stops), slept.append)
    assert slept == [runner.IDLE, runner.AFTER_ERROR]
    every, daily = runner.due_times("15m", T0), runner.due_times("04:20", T0 + 5 * H)
    assert [next(every), next(every)] == [T0 + H / 4, T0 + H / 2] and [next(daily), next(daily)] == [T0 + timedelta(days=d, hours=4, minutes=20) for d in (1, 2)]


def test_a_stream_equals_one_batch(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type", "value")
    double = lambda df: df.select("event_id", (F.col("value") * 2).alias("v"))
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.mode("append").parquet(source)
        runner.stream(spark.readStream.schema(events.schema).parquet(source), double, out, check).awaitTermination()
    assert spark.read.parquet(out).drop("batch").exceptAll(double(events)).count() == 0 and spark.read.parquet(out).count() == events.count()


def test_tumbling_windows_of_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.parquet(source)
    stream = runner.tumbling(spark.readStream.schema(events.schema).parquet(source), "ts", timedelta(weeks=1), ["event_type"], "value", H)
    stream.writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    got = {(r.window.start, r.event_type): r.n for r in spark.table("weeks").collect()}
    want = {(r.w, r.event_type): r.n for r in events.groupBy(F.date_trunc("week", "ts").alias("w"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got == want


ITEM = "struct<directionId:string,distanceFromPoint:int,pointId:string,lineId:string>"
TYPES = {"directionId": "string", "distanceFromPoint": "integer", "pointId": "string"}


def document(*lines, **more):
    return json.dumps([{"directionId": "1", "distanceFromPoint": 5, "pointId": "p", "lineId": n} | more for n in lines])


def test_validation(spark):
    cases = [document("1"), "[]", "{}", '[{"pointId": 5}]', '[{"other": 1}]', '[{"distanceFromPoint": 1.5}]', "[1]", document("1", distanceFromPoint="x"), '[{"lineId": 7}]']
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, data string")
    got = [r.v for r in df.orderBy("k").select(compaction.valid_items(F.parse_json("data"), TYPES).alias("v")).collect()]
    assert got == [True, True, False, False, True, False, False, False, True]


def test_archive_by_levels(spark, tmp_path):
    archive = compaction.Archive(spark, str(tmp_path / "a"), [("1h", []), ("1d", []), ("1w", ["lineId"])])
    docs = [(T0 + k * H / 2, document("1", "2") if k % 3 else document("1")) for k in range(2 * 24 * 8)] + [(T0 + timedelta(minutes=59, seconds=59), '[{"pointId": 1}]')]
    source = rows(spark, *docs)
    assert archive.run(source.limit(0), ITEM, TYPES, "lineId", T0) == []
    assert len(archive.run(source, ITEM, TYPES, "lineId", T0 + 3 * H + H / 2)) == 3
    assert len(archive.run(source, ITEM, TYPES, "lineId", T0 + timedelta(days=8))) == 8 * 24 - 3 + 8 + 1
    assert archive.run(source, ITEM, TYPES, "lineId", T0 + timedelta(days=8)) == []
    manifest = archive.manifest()
    levels = {r.level: r for r in manifest.groupBy("level").agg(F.count("*").alias("n"), F.sum("row_count").alias("rows"), F.sum("skipped").alias("skipped")).collect()}
    hours = [r for r in manifest.where("level = '1h'").orderBy("start_date").collect()]
    assert (hours[0].doc_count, hours[0].row_count, hours[0].skipped) == (2, 3, 1) and len(hours) == 192
    assert levels["1h"]["rows"] == levels["1d"]["rows"] == 2 * 384 - 128
    week = {r["keys"]["lineId"]: r for r in manifest.where("level = '1w'").collect()}
    assert set(week) == {"1", "2"} and week["1"].row_count == 336 and week["1"].doc_count == 336 and week["1"].skipped == 1
    assert {(r.level, r["count"]) for r in archive.current().groupBy("level").count().collect()} == {("1d", 8), ("1w", 2)}
    assert archive.vacuum() == 192 and archive.vacuum() == 0 and archive.run(source, ITEM, TYPES, "lineId", T0 + timedelta(days=8)) == []
    back = spark.read.parquet(week["1"].data)
    assert back.count() == week["1"].row_count + week["2"].row_count and back.agg(F.max("date")).first()[0] < T0 + timedelta(weeks=1)


def test_complete_periods():
    assert compaction.complete_periods(T0 + H / 2, T0 + 2.5 * H, "1h") == [(T0, T0 + H), (T0 + H, T0 + 2 * H)]
    assert compaction.complete_periods(T0, T0 + 2 * H, "1h", T0 + H) == [(T0 + H, T0 + 2 * H)] and compaction.complete_periods(T0, T0 + H / 2, "1h") == []


HANDLERS = {
    "trips": service.Handler(lambda start=0, end=None: {"start": start, "end": end}, {"start": "int", "end": "float"}), "none": service.Handler(lambda: None),
    "text": service.Handler(lambda: "t", data_type="text"), "bytes": service.Handler(lambda: b"\0", data_type="bytes"),
}


@pytest.mark.parametrize(("url", "want"), [
    ("/trips?start=5", (200, "application/json", b'{"start": 5, "end": null}')), ("/trips?start=x", 400), ("/trips?other=1", 400), ("/nope", 404), ("/none", 404),
    ("/text", (200, "text/plain", b"t")), ("/bytes", (200, "application/octet-stream", b"\0")),
])
def test_answers(url, want):
    got = service.answer(HANDLERS, url, "1.2.3.4")
    assert got == want if isinstance(want, tuple) else got[0] == want
    assert service.answer(HANDLERS, url, "1.2.3.4", ["5.6.7.8"])[0] == 403


def test_server():
    server = service.serve(HANDLERS, "127.0.0.1", 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}"
        assert json.load(urlopen(f"{base}/trips?end=2")) == {"start": 0, "end": 2.0}
        with pytest.raises(HTTPError):
            urlopen(f"{base}/nope")
    finally:
        server.shutdown()
