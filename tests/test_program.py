import json
import threading
from datetime import datetime, timedelta
from urllib.request import urlopen

import pytest
from pyspark.sql import functions as F

from tramlake import program
from tramlake.plans import gtfs
from tramlake.sources.catalog import Catalog

T0 = datetime(2024, 1, 1)
CONFIG = """
[[collectors]]
name = "raw"
run = "test_program:collected"
schedule = "20s"
[collectors.parquetize]
batch = "1h"
types = { pointId = "string", lineId = "string" }
groups = [{ period = "1d", keys = ["lineId"] }]
[[harvesters]]
name = "count"
run = "test_program:counted"
source = "raw"
[[handlers]]
name = "newest"
run = "test_program:newest"
query_parameters = { table = "str" }
"""


def collected():
    return json.dumps([{"pointId": "p", "lineId": "1"}])


def counted(raw):
    return raw.agg(F.count("*").cast("string").alias("data"))


def newest(catalog, table="city_raw"):
    return catalog.latest(table).first().data


@pytest.fixture
def config(tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "city.toml").write_text(CONFIG)
    return str(tmp_path / "c"), str(tmp_path / "catalog")


def test_everything_once(spark, config):
    times = iter([T0 + timedelta(minutes=30), T0 + timedelta(hours=3)])
    assert program.main([*config, "--collect", "all", "--derive", "all", "--compact", "all", "--once"], spark, now=lambda: next(times)) == []
    catalog = Catalog(spark, config[1])
    assert json.loads(newest(catalog)) == [{"pointId": "p", "lineId": "1"}] and newest(catalog, "city_count") == "1"
    manifest = spark.read.parquet(f"{config[1]}-archive/city_raw/manifest").collect()
    assert [(r.level, r.start_date, r.row_count) for r in manifest] == [("1h", T0, 1)]
    with pytest.raises(ValueError):
        program.main([*config, "--serve", "all", "--once"], spark)


def test_loops_until_stopped(spark, config):
    stop, clock = threading.Event(), [T0]

    def now():
        clock[0] += timedelta(seconds=7)
        return clock[0]

    threads = program.main([*config, "--collect", "city_raw", "--derive", "city_count", "--serve", "all", "--port", "8931"], spark, stop, now)
    catalog = Catalog(spark, config[1])
    for _ in range(600):
        if catalog.raw("city_count").count() > 1:
            break
        stop.wait(0.1)
    assert catalog.raw("city_raw").count() > 1 and json.load(urlopen("http://localhost:8931/city_newest?table=city_count")) == 1
    stop.set()
    for t in threads:
        t.join(60)
        assert not t.is_alive()


def test_a_failing_step_does_not_end_the_schedule():
    clock, done, stop = [T0], [], threading.Event()

    def step():
        done.append(clock[0])
        if len(done) == 3:
            stop.set()
        raise ValueError

    def wait(seconds):
        clock[0] += timedelta(seconds=seconds)

    program.on_schedule(step, "20s", stop, lambda: clock[0], wait)
    assert done == [T0 + timedelta(seconds=20 * k) for k in (1, 2, 3)]


def test_an_action_within_its_time(spark):
    slow = spark.range(100, numPartitions=4).mapInPandas(lambda parts: (__import__("time").sleep(30) or p for p in parts), "id long")
    assert gtfs.within_time(spark, 1.0, slow.count) is None
    assert gtfs.within_time(spark, 60.0, spark.range(5).count) == 5
    with pytest.raises(ZeroDivisionError):
        gtfs.within_time(spark, 60.0, lambda: 1 / 0)
