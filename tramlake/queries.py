"""Registered queries over the test tables, each with its SQL for another engine."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tramlake.functions import geo, text, time
from tramlake.functions.numbers import rounded
from tramlake.operators import asof, matching, ordering, statistics
from tramlake.plans import compaction, gtfs, identify, rail, trajectories
from tramlake.sources import feeds, geojson
from tramlake.sources.catalog import Catalog
from tramlake.streaming import incremental, runner

QUERIES: dict = {}
SQL: dict[str, str] = {}

START, MIDDLE, END = datetime(2024, 1, 8), datetime(2024, 1, 15), datetime(2024, 1, 22)


def query(sql: str | None = None):
    """Registers a query under its function's name; its tables are the function's further parameters."""

    def registered(f):
        tables = f.__code__.co_varnames[: f.__code__.co_argcount]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return registered


def day(column: str = "ts"):
    return F.date_trunc("day", F.col(column)).cast("timestamp_ntz")


# Catalog reads


@query("SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC LIMIT 1")
def catalog_latest(events):
    return ordering.newest(events.select("event_id", "ts", "user_id", "event_type", "value"), "ts")


@query("SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts LIMIT 1")
def catalog_first(events):
    return ordering.oldest(events.select("event_id", "ts", "user_id", "event_type", "value"), "ts")


@query(f"SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '{MIDDLE}' ORDER BY ts DESC LIMIT 20")
def catalog_after(events):
    return ordering.after(events.select("event_id", "ts", "value"), "ts", MIDDLE, 20)


@query(f"SELECT event_id, ts, value FROM events WHERE ts < TIMESTAMP '{MIDDLE}' ORDER BY ts DESC LIMIT 20")
def catalog_before(events):
    return ordering.before(events.select("event_id", "ts", "value"), "ts", MIDDLE, 20)


@query(f"SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' ORDER BY ts LIMIT 50")
def catalog_between(events):
    return ordering.between(events.select("event_id", "ts", "value"), "ts", START, END, 50)


@query(f"SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '{START}'")
def catalog_open_start(events):
    return ordering.between(events.select("event_id", "ts"), "ts", end=START, ordered=False)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-02-01'")
def catalog_closed_interval(orders):
    return ordering.within(orders.select("o_orderkey", "o_orderdate"), "o_orderdate", datetime(1997, 1, 1), datetime(1997, 2, 1))


@query("""
SELECT event_id, CASE WHEN event_id = first THEN props END AS props, CASE WHEN event_id = first THEN h END AS hash, CASE WHEN event_id <> first AND h IS NOT NULL THEN first END AS copy_id
FROM (SELECT event_id, props, md5(props) AS h, min(event_id) OVER (PARTITION BY md5(props)) AS first FROM events)""")
def copy_pointer_write(events):
    return matching.point_to_copies(events.select("event_id", "props"), "event_id", "props").select("event_id", "props", "hash", "copy_id")


@query("SELECT event_id, props FROM events")
def copy_pointer_read(events):
    return matching.resolve_copies(matching.point_to_copies(events.select("event_id", "props"), "event_id", "props"), "event_id", "props").select("event_id", "props")


@query("SELECT event_id, md5(props) AS hash FROM events WHERE value >= 1")
def tombstone_filter(events):
    rows = events.select("event_id", F.when(F.col("value") >= 1, F.md5(F.col("props").cast("binary"))).alias("hash"), F.lit(None).cast("long").alias("copy_id"))
    return matching.without_tombstones(rows).select("event_id", "hash")


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def payload_decode(events):
    return events.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS day, user_id, event_id, value FROM events")
def payload_explode(events):
    packed = events.groupBy(day().alias("day"), "user_id").agg(F.collect_list(F.struct("event_id", "value")).alias("items"))
    return packed.select("day", "user_id", F.inline("items"))


@query("""
SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) FILTER (json_extract(props, '$.k')::BIGINT BETWEEN 0 AND 49)::BIGINT AS valid,
       count(*) FILTER (json_extract(props, '$.k')::BIGINT NOT BETWEEN 0 AND 49)::BIGINT AS skipped
FROM events GROUP BY 1""")
def json_validate_count(events):
    k = F.from_json("props", "k long")["k"]
    return events.groupBy(day().alias("day")).agg(F.count_if(k.between(0, 49)).alias("valid"), F.count_if(~k.between(0, 49)).alias("skipped"))


# Windows of snapshots


def daily(events) -> DataFrame:
    """A snapshot a day: the mean value of each user and event type."""
    return events.groupBy(day().alias("day"), "user_id", "event_type").agg(F.avg("value").alias("distance"))


def speeds(events) -> DataFrame:
    pairs = ordering.count_windows(daily(events), "day", F.date_trunc("month", F.col("day")), 2)
    return statistics.pair_speed(pairs.withColumn("distance", rounded(F.col("distance"), 4)), ["user_id", "event_type"], "place", "distance", F.timestamp_diff("SECOND", F.col("then.day"), F.col("now.day")))


PAIRS = """
WITH snapshots AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, user_id, event_type, round_even(avg(value) * 1e4, 0) / 1e4 AS distance FROM events GROUP BY ALL),
placed AS (SELECT *, (dense_rank() OVER (ORDER BY day) - 1) // 2 AS w, (dense_rank() OVER (ORDER BY day) - 1) % 2 + 1 AS place FROM snapshots),
joined AS (
  SELECT n.w AS "window", n.user_id, n.event_type, n.distance AS d2, t.distance AS d1, epoch(n.day - t.day) AS seconds,
         count(*) OVER (PARTITION BY n.w, n.user_id, n.event_type) AS rows
  FROM placed n JOIN placed t ON n.w = t.w AND n.user_id = t.user_id AND n.event_type = t.event_type WHERE n.place = 2 AND t.place = 1),
speeds AS (SELECT "window"::BIGINT AS "window", user_id, event_type, round_even((d2 - d1) / seconds * 3.6 * 100, 0) / 100 AS speed FROM joined WHERE rows = 1 AND d1 < d2)
"""


@query(PAIRS + "SELECT * FROM speeds")
def pair_speed(events):
    return speeds(events)


@query(PAIRS + "SELECT user_id, event_type, round_even(avg(speed) * 1e6, 0) / 1e6 AS speed FROM speeds GROUP BY ALL")
def aggregated_speed(events):
    out = statistics.mean_by(speeds(events), ["user_id", "event_type"], "speed", "speed")
    return out.withColumn("speed", rounded(F.col("speed"), 6))


WEEKS = """
SELECT w::BIGINT AS "window", count(*)::BIGINT AS n, min(ts) AS first, max(ts) AS last
FROM (SELECT ts, (dense_rank() OVER (ORDER BY date_trunc('day', ts)) - 1) // 7 AS w, date_trunc('day', ts) AS d FROM events) GROUP BY w"""


def sevens(events, strict: bool) -> DataFrame:
    rows = ordering.count_windows(events.select("ts", day().alias("day")), "day", F.date_trunc("month", F.col("day")), 7, strict)
    return rows.groupBy("window").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(WEEKS + " HAVING count(DISTINCT d) = 7")
def count_window_strict(events):
    return sevens(events, True)


@query(WEEKS)
def count_window_lenient(events):
    return sevens(events, False)


@query("""
SELECT l_partkey, l_suppkey, l_returnflag, round_even(avg(l_quantity) * 1e6, 0) / 1e6 AS quantity FROM lineitem
WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY ALL""")
def mean_by_keys(lineitem):
    return statistics.mean_by(lineitem, ["l_partkey", "l_suppkey", "l_returnflag"], "l_quantity", "quantity").withColumn("quantity", rounded(F.col("quantity"), 6))


# Duplicates


LINE = ["l_orderkey", "l_linenumber"]
TIES = ["l_extendedprice", "l_partkey", "l_suppkey"]


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1")
def dedupe_discard_all(lineitem):
    return ordering.unique_keys(lineitem.select(*LINE, "l_extendedprice"), LINE)


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""")
def dedupe_keep_first(lineitem):
    return ordering.first_of_group(lineitem.select(*LINE, *TIES), LINE, TIES)


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def dedupe_keep_last(lineitem):
    return ordering.first_of_group(lineitem.select(*LINE, *TIES), LINE, [F.col(c).desc() for c in TIES])


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(part):
    return part.select("p_brand", "p_type").distinct()


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1")
def having_multi(orders):
    return ordering.several(orders.select("o_custkey", "o_orderkey"), ["o_custkey"])


@query("SELECT p_brand, max(p_type) AS label FROM part GROUP BY p_brand")
def max_label(part):
    return part.groupBy("p_brand").agg(F.max("p_type").alias("label"))


@query("SELECT c_custkey, c_nationkey, o_orderkey IS NOT NULL AS has_order, count(o_orderkey)::BIGINT AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def split_by_null(customer, orders):
    joined = customer.join(orders.groupBy("o_custkey").agg(F.count("*").alias("n")), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_nationkey", "n")
    found, missing = joined.where("n IS NOT NULL"), joined.where("n IS NULL")
    return found.withColumn("has_order", F.lit(True)).unionByName(missing.drop("n").withColumn("has_order", F.lit(False)).withColumn("n", F.lit(0).cast("long")))


# Joins


@query("""
WITH keyed AS (SELECT o_orderkey, o_custkey, (o_orderkey % 7)::INTEGER AS k FROM orders),
exact AS (SELECT o.o_orderkey, c_name AS label, 5::INTEGER AS confidence FROM keyed o JOIN customer ON c_custkey = o_custkey AND c_nationkey = k),
loose AS (
  SELECT o_orderkey, n_name AS label, 4::INTEGER AS confidence, count(*) OVER (PARTITION BY o_orderkey) AS n
  FROM keyed JOIN (SELECT n_nationkey AS k, n_name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region) USING (k) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM exact))
SELECT * FROM exact UNION ALL SELECT o_orderkey, label, confidence FROM loose WHERE n = 1""")
def match_then_fallback(orders, customer, nation, region):
    rows = orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 7).cast("int").alias("k"))
    exact = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k"), F.col("c_name").alias("label"))
    # Keys below 5 have two loose matches, a nation and a region; 5 and 6 have one.
    loose = nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("label")).union(region.select("r_regionkey", "r_name"))
    return matching.match_or_fall_back(rows, exact, loose, "o_orderkey", ["o_custkey", "k"], ["k"], "label")


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, a.p_name AS name_start, b.s_name AS name_end
FROM lineitem JOIN part a ON l_partkey = a.p_partkey JOIN supplier b ON l_suppkey = b.s_suppkey""")
def two_dim_join(lineitem, part, supplier):
    """A row's two ends, each named by a table of its own."""
    start = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name_start"))
    end = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name_end"))
    return lineitem.join(start, "l_partkey").join(end, "l_suppkey").select("l_orderkey", "l_linenumber", "l_extendedprice", "name_start", "name_end")


@query("""
SELECT s_suppkey, c_custkey, c_name FROM supplier LEFT JOIN customer ON s_nationkey = c_nationkey AND s_name <> c_name
QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY c_custkey) = 1""")
def theta_first_match(supplier, customer):
    others = customer.select("c_custkey", "c_nationkey", "c_name")
    return matching.first_other(supplier, others, {"s_nationkey": "c_nationkey"}, ("s_name", "c_name"), ["c_custkey"]).select("s_suppkey", "c_custkey", "c_name")


LINES = """WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1)"""


@query(LINES + """
SELECT l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey AS l_partkey_next FROM lines a JOIN (SELECT l_orderkey, l_linenumber - 1 AS before, l_partkey FROM lines) b USING (l_orderkey)
WHERE a.l_linenumber = b.before""")
def successor_join(lineitem):
    lines = ordering.first_of_group(lineitem, LINE, TIES).select(*LINE, "l_partkey")
    return matching.with_successor(lines, "l_orderkey", "l_linenumber", ["l_partkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, round_even(date_diff('day', o_orderdate, TIMESTAMP '1998-01-01') / date_diff('day', o_orderdate, l_shipdate) * 1e6, 0) / 1e6 AS completion
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '1998-01-01' AND l_shipdate > TIMESTAMP '1998-01-01'""")
def in_progress_at(lineitem, orders):
    at = time.moment(datetime(1998, 1, 1))
    running = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where((F.col("o_orderdate") < at) & (F.col("l_shipdate") > at))
    done = F.timestamp_diff("DAY", F.col("o_orderdate"), at) / F.timestamp_diff("DAY", F.col("o_orderdate"), F.col("l_shipdate"))
    return running.select("l_orderkey", "l_linenumber", "l_extendedprice", rounded(done, 6).alias("completion"))


def sides(events):
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    return purchases, clicks


ASOF = """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, ts AS click_ts, event_id AS click_id FROM events WHERE event_type = 'click')
"""


@query(ASOF + "SELECT event_id, p.user_id, ts, click_id FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts > c.click_ts")
def asof_join(events):
    purchases, clicks = sides(events)
    return asof.asof(purchases, clicks, ["user_id"], "ts", "click_ts", ["click_id"]).select("event_id", "user_id", "ts", "click_id")


@query(ASOF + """
SELECT event_id, age, click_id FROM (SELECT event_id, click_id, row_number() OVER (PARTITION BY event_id ORDER BY click_ts DESC) AS age FROM p JOIN c ON p.user_id = c.user_id AND c.click_ts < p.ts) WHERE age <= 3""")
def asof_top_n(events):
    purchases, clicks = sides(events)
    return asof.asof_last_n(purchases, clicks, ["user_id"], "ts", "click_ts", ["click_id"], 3).select("event_id", "age", "click_id")


@query(ASOF + """
SELECT event_id, coalesce(click_id, (SELECT max_by(click_id, click_ts) FROM c)) AS click_id FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts > c.click_ts""")
def asof_fallback(events):
    purchases, clicks = sides(events)
    return asof.asof_or_latest(purchases, clicks, ["user_id"], "ts", "click_ts", "click_id").select("event_id", "click_id")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_join(customer, orders):
    return customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def anti_join(customer, orders):
    return customer.join(orders.where("o_totalprice > 200000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""
WITH a AS (SELECT event_id AS click_id, row_number() OVER (ORDER BY ts) AS position FROM events WHERE event_type = 'click'),
b AS (SELECT event_id AS view_id, row_number() OVER (ORDER BY ts) AS position FROM events WHERE event_type = 'view')
SELECT position::BIGINT AS position, click_id, view_id FROM a JOIN b USING (position)""")
def zip_join(events):
    clicks = events.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    views = events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return ordering.zipped(clicks, views, ["click_ts"], ["view_ts"], F.date_trunc("day", "click_ts"), F.date_trunc("day", "view_ts")).select("position", "click_id", "view_id")


# Buckets and compaction


def bucketed(events, delta: timedelta) -> DataFrame:
    return events.groupBy(time.bucket(F.col("ts"), delta).alias("bucket")).agg(F.count("*").alias("n"), rounded(F.sum("value"), 4).alias("total"))


def bucket_sql(unit: str) -> str:
    return f"SELECT date_trunc('{unit}', ts)::TIMESTAMP AS bucket, count(*)::BIGINT AS n, round_even(sum(value) * 1e4, 0) / 1e4 AS total FROM events GROUP BY 1"


@query(bucket_sql("hour"))
def bucket_hour(events):
    return bucketed(events, timedelta(hours=1))


@query(bucket_sql("day"))
def bucket_day(events):
    return bucketed(events, timedelta(days=1))


@query(bucket_sql("week"))
def bucket_week(events):
    return bucketed(events, timedelta(weeks=1))


LEVELS = """
WITH hours AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS start, count(*) AS documents, sum(strlen(props)) AS size FROM events WHERE json_extract(props, '$.k')::BIGINT < 90 GROUP BY 1),
skips AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS start, count(*) AS skipped FROM events WHERE json_extract(props, '$.k')::BIGINT >= 90 GROUP BY 1),
batches AS (SELECT coalesce(hours.start, skips.start) AS start, coalesce(documents, 0) AS documents, coalesce(skipped, 0) AS skipped, coalesce(size, 0) AS size FROM hours FULL JOIN skips ON hours.start = skips.start)
"""


@query(LEVELS + """
SELECT '1h' AS level, start, documents::BIGINT AS documents, skipped::BIGINT AS skipped, size::BIGINT AS size FROM batches
UNION ALL SELECT '1d', date_trunc('day', start)::TIMESTAMP, sum(documents)::BIGINT, sum(skipped)::BIGINT, sum(size)::BIGINT FROM batches GROUP BY 2
UNION ALL SELECT '1w', date_trunc('week', start)::TIMESTAMP, sum(documents)::BIGINT, sum(skipped)::BIGINT, sum(size)::BIGINT FROM batches GROUP BY 2""")
def compaction_levels(events):
    documents = events.select(F.col("ts").alias("date"), (F.from_json("props", "k long")["k"] < 90).alias("valid"), F.octet_length("props").alias("size"))
    return compaction.level_statistics(documents, ["1h", "1d", "1w"])


@query("""
WITH parts AS (SELECT date_trunc('week', ts)::TIMESTAMP AS start, event_type, count(*) AS n, sum(strlen(props)) AS size FROM events GROUP BY ALL)
SELECT start, event_type, n::BIGINT AS row_count, round_even(sum(size) OVER w / sum(n) OVER w * n * 1e6, 0) / 1e6 AS size FROM parts WINDOW w AS (PARTITION BY start)""")
def proportional_size(events):
    rows = events.select(F.col("ts").alias("date"), "event_type", F.octet_length("props").alias("size"))
    return compaction.keyed_statistics(rows, "1w", ["event_type"])


BOTH = """
SELECT week, sum(closed)::BIGINT AS closed, sum(half_open)::BIGINT AS half_open FROM (
  SELECT date_trunc('week', o_orderdate)::TIMESTAMP AS week, 1 AS closed, 1 AS half_open FROM orders
  UNION ALL SELECT (date_trunc('week', o_orderdate) - INTERVAL 7 DAY)::TIMESTAMP, 1, 0 FROM orders WHERE o_orderdate = date_trunc('week', o_orderdate)) GROUP BY week"""


@query(BOTH)
def closed_vs_half_open(orders):
    return compaction.closed_and_half_open(orders, "o_orderdate", timedelta(weeks=1), "week")


@query("SELECT event_type, count(*)::BIGINT AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def keyed_parts(events):
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a file set a key into the shared folder and counts what it reads back."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    back = compaction.written_by_key(events.select("event_id", "event_type", "value"), ["event_type"])
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


QUERIES["partitioned_write"], SQL["partitioned_write"] = partitioned_write, SQL["keyed_parts"]
del QUERIES["keyed_parts"], SQL["keyed_parts"]


# Incremental processing


@query(f"SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{MIDDLE}')")
def watermark_incremental(events):
    rows = events.select("event_id", "ts")
    return incremental.unseen(rows, rows.where(F.col("ts") < time.moment(MIDDLE)), "ts")


@query("""
SELECT greatest(min(ts) - INTERVAL 1 SECOND, min(ts) FILTER (event_type = 'purchase') - INTERVAL 1 SECOND, min(ts) FILTER (event_type = 'click') - INTERVAL 1 SECOND)::TIMESTAMP AS watermark FROM events""")
def warmup_clamp(events):
    required = [events.where(F.col("event_type") == k).select("ts") for k in ("purchase", "click")]
    return incremental.starting_watermark(events.select("ts"), None, required, [], "ts")


# Trajectories and statistics


@query("""
SELECT user_id, count(*)::BIGINT AS n, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS path FROM events
WHERE ts > TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY user_id HAVING count(*) > 1""")
def trajectory(events):
    rows = ordering.between(events.select("user_id", "event_id", "ts"), "ts", START, END, ordered=False)
    path = trajectories.ordered_list(rows, ["user_id"], ["ts", "event_id"], ["event_id"], least=2)
    return path.select("user_id", F.size("items").cast("long").alias("n"), F.array_join(F.transform("items", lambda x: x["event_id"].cast("string")), ",").alias("path"))


@query("SELECT event_id, user_id, round_even((value - lag(value) OVER (PARTITION BY user_id ORDER BY ts)) * 1e6, 0) / 1e6 AS delta FROM events")
def pair_delta(events):
    return statistics.deltas(events, "user_id", "ts", "value").select("event_id", "user_id", rounded(F.col("delta"), 6).alias("delta"))


@query("""
SELECT event_id, CASE WHEN max(value) OVER w = min(value) OVER w THEN 0.0::DOUBLE ELSE round_even((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) * 1e6, 0) / 1e6 END AS share
FROM events WINDOW w AS (PARTITION BY user_id)""")
def minmax_normalise(events):
    return statistics.normalised(events, ["user_id"], "value", "share").select("event_id", rounded(F.col("share"), 6).alias("share"))


@query("""
SELECT event_id, event_type, round_even(z * 1e6, 0) / 1e6 AS z FROM (
  SELECT event_id, event_type, (value - avg(value) OVER w) / stddev_pop(value) OVER w AS z FROM events WINDOW w AS (PARTITION BY event_type)) WHERE abs(z) > 4""")
def zscore_outliers(events):
    return statistics.z_outliers(events, ["event_type"], "value", 4.0).select("event_id", "event_type", rounded(F.col("z"), 6).alias("z"))


@query("""
SELECT event_type, round_even(regr_slope(value, x) * 1e10, 0) / 1e10 AS slope, round_even(regr_intercept(value, x) * 1e6, 0) / 1e6 AS intercept
FROM (SELECT event_type, value, date_diff('microsecond', min(ts) OVER (PARTITION BY event_type), ts) / 1e6 AS x FROM events) GROUP BY event_type""")
def ols(events):
    return statistics.ols(events, "event_type", "ts", "value").select("event_type", rounded(F.col("slope"), 10).alias("slope"), rounded(F.col("intercept"), 6).alias("intercept"))


@query(LINES + """
SELECT o_orderkey, o_orderpriority, string_agg(l_linenumber || '@' || strftime(l_shipdate, '%Y-%m-%d'), ';' ORDER BY l_linenumber) AS schedule
FROM orders JOIN lines ON o_orderkey = l_orderkey GROUP BY ALL""")
def nested_schedule(orders, lineitem):
    lines = ordering.first_of_group(lineitem, LINE, TIES)
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    nested = trajectories.ordered_list(rows, ["o_orderkey", "o_orderpriority"], ["l_linenumber"], ["l_linenumber", "l_shipdate"])
    stop = lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit("@"), F.date_format(x["l_shipdate"], "yyyy-MM-dd"))
    return nested.select("o_orderkey", "o_orderpriority", F.array_join(F.transform("items", stop), ";").alias("schedule"))


# Scalars


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' WHEN 'P' THEN 'partial' END AS status FROM orders")
def value_map(orders):
    return orders.select("o_orderkey", text.mapped(F.col("o_orderstatus"), {"O": "open", "F": "finished", "P": "partial"}).alias("status"))


@query("""
SELECT c_custkey, translate(regexp_replace(line, '^0+', ''), 'BMTbmt', '') AS generic,
       translate(regexp_replace(CASE WHEN contains(line, 'N') THEN '2' || substr(line, 2) ELSE line END, '^0+', ''), 'BMT', '')::INTEGER AS gtfs,
       translate(regexp_replace(CASE WHEN line LIKE '2%' THEN 'N' || substr(line, 2) ELSE line END, '^0+', ''), 'bmt', '') AS shape,
       regexp_replace(trim(' ' || line || '.0'), '\\.0$|T', '', 'g') AS live, regexp_replace(trim(' ' || line || '.0'), '.0|T', '', 'g') AS live_compat,
       CASE WHEN regexp_replace(c_name, '[A-Za-z#]', '', 'g') = '' THEN 0 ELSE regexp_replace(c_name, '[A-Za-z#]', '', 'g')::BIGINT END AS stop
FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN 'N' || c_custkey % 90 + 10 WHEN 1 THEN '0' || c_custkey % 90 + 1 || 'T' WHEN 2 THEN '2' || c_custkey % 9 + 1 ELSE '0' || c_custkey % 60 + 1 || 'M' END AS line FROM customer)""")
def code_cleanup(customer):
    k, number = F.col("c_custkey") % 4, lambda n, plus: (F.col("c_custkey") % n + plus).cast("string")
    line = (
        F.when(k == 0, F.concat(F.lit("N"), number(90, 10))).when(k == 1, F.concat(F.lit("0"), number(90, 1), F.lit("T")))
        .when(k == 2, F.concat(F.lit("2"), number(9, 1))).otherwise(F.concat(F.lit("0"), number(60, 1), F.lit("M")))
    )
    rows = customer.select("c_custkey", "c_name", line.alias("line"), F.concat(F.lit(" "), line, F.lit(".0")).alias("live"))
    c = F.col("line")
    return rows.select(
        "c_custkey", text.generic_line(c).alias("generic"), text.gtfs_line_number(c).alias("gtfs"), text.shape_line_name(c).alias("shape"), text.live_line_name(F.col("live")).alias("live"),
        text.live_line_name(F.col("live"), compat=True).alias("live_compat"), text.stop_number(F.regexp_replace("c_name", "#", "")).alias("stop"),
    )


@query("SELECT p_partkey, translate(upper(p_name), ' ''', '') AS name, regexp_replace(translate(upper(p_type), ' ''', ''), '\\((A|B)\\)', '', 'g') AS station FROM part")
def name_cleanup(part):
    return part.select("p_partkey", text.operator_station_key(F.col("p_name")).alias("name"), text.station_key(F.col("p_type")).alias("station"))


@query("SELECT event_id, coalesce(props ->> '$.fr', props ->> '$.k', '') AS name FROM events")
def fr_nl_fallback(events):
    return events.select("event_id", text.member(F.col("props"), "$.fr", "$.k").alias("name"))


@query("SELECT DISTINCT name, p_size FROM (SELECT p_brand AS name, p_size FROM part UNION ALL SELECT p_type, p_size FROM part)")
def unpivot_names(part):
    return part.select(F.explode(F.array("p_brand", "p_type")).alias("name"), "p_size").distinct()


@query("""
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::BIGINT AS suppkey FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier""")
def union_by_name(customer, supplier):
    a = customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = supplier.select(F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS blob, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
       printf('%02d:%02d:%02d', s % 86400 // 3600, s % 3600 // 60, s % 60) AS clock, s AS seconds
FROM (SELECT *, ((o_orderkey * 37) % 100000)::INTEGER AS s FROM orders)""")
def time_formats(orders):
    rows = orders.withColumn("s", ((F.col("o_orderkey") * 37) % 100000).cast("int"))
    spoken = F.concat_ws(":", *(F.lpad(x.cast("int").cast("string"), 2, "0") for x in (F.floor(F.col("s") / 3600), F.floor(F.col("s") % 3600 / 60), F.col("s") % 60)))
    return rows.select("o_orderkey", time.blob_name(F.col("o_orderdate")).alias("blob"), time.iso_micros(F.col("o_orderdate")).alias("iso"), time.clock(F.col("s")).alias("clock"), time.seconds_of_day(spoken).alias("seconds"))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN n IN (1, 2, 5, 6) THEN 250 WHEN n IN (3, 4, 7, 8, 9, 19, 25, 39, 44, 51, 55, 62, 81, 82, 92, 93, 97) THEN 60 ELSE 80 END::INTEGER AS cap,
       CASE WHEN n = 12 THEN 100 WHEN n IN (3, 4, 7, 8, 9, 19, 25, 39, 44, 51, 55, 62, 81, 82, 92, 93, 97) THEN 30 ELSE 50 END::INTEGER AS legal
FROM (SELECT *, l_partkey % 100 AS n FROM lineitem)""")
def speed_limits(lineitem):
    line = (F.col("l_partkey") % 100).cast("string")
    return lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", text.max_speed(line).alias("cap"), text.legal_limit(line).alias("legal"))


# Geometry


def polylines(embeddings, n: int = 8) -> DataFrame:
    line = F.array(*(geo.point(F.col("embedding")[2 * k], F.col("embedding")[2 * k + 1]) for k in range(n)))
    return embeddings.select("vec_id", line.alias("line"), geo.point(F.col("embedding")[2 * n], F.col("embedding")[2 * n + 1]).alias("p"))


SEGMENTS = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
seg AS (
  SELECT vec_id, k, e[2 * k + 1] AS ax, e[2 * k + 2] AS ay, e[2 * k + 3] AS bx, e[2 * k + 4] AS "by", e[17] AS px, e[18] AS py
  FROM v, (SELECT unnest(range(0, 7)) AS k)),
measured AS (SELECT *, sqrt((ax - bx) * (ax - bx) + (ay - "by") * (ay - "by")) AS size FROM seg),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY vec_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed,
  sum(size) OVER (PARTITION BY vec_id) AS whole FROM measured)
"""


@query("SELECT vec_id, e[1] AS x, e[2] AS y FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) WHERE e[1] BETWEEN -0.1 AND 0.1 AND e[2] BETWEEN -0.1 AND 0.1")
def point_bbox(embeddings):
    p = embeddings.select("vec_id", geo.point(F.col("embedding")[0], F.col("embedding")[1]).alias("p"))
    return p.where(geo.in_box(F.col("p"), -0.1, -0.1, 0.1, 0.1)).select("vec_id", "p.x", "p.y")


@query(SEGMENTS + "SELECT vec_id, round_even(sum(size) * 1e6, 0) / 1e6 AS length FROM measured GROUP BY vec_id")
def line_length(embeddings):
    return polylines(embeddings).select("vec_id", rounded(geo.length(F.col("line")), 6).alias("length"))


@query(SEGMENTS + """, halves AS (
  SELECT *, (0.5 * whole - passed) / size AS share FROM placed WHERE passed + size >= 0.5 * whole QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY k) = 1)
SELECT vec_id, round_even((ax + (bx - ax) * share) * 1e6, 0) / 1e6 AS x, round_even((ay + ("by" - ay) * share) * 1e6, 0) / 1e6 AS y FROM halves""")
def line_interpolate(embeddings):
    at = polylines(embeddings).select("vec_id", geo.interpolate(F.col("line"), F.lit(0.5), normalised=True).alias("at"))
    return at.select("vec_id", rounded(F.col("at.x"), 6).alias("x"), rounded(F.col("at.y"), 6).alias("y"))


@query(SEGMENTS + """, shares AS (
  SELECT *, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * ("by" - ay)) / (size * size))) AS share FROM placed),
fars AS (SELECT *, sqrt((ax + (bx - ax) * share - px) * (ax + (bx - ax) * share - px) + (ay + ("by" - ay) * share - py) * (ay + ("by" - ay) * share - py)) AS far FROM shares)
SELECT vec_id, round_even((passed + share * size) * 1e6, 0) / 1e6 AS travelled, round_even(far * 1e6, 0) / 1e6 AS far FROM fars QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, k) = 1""")
def line_project(embeddings):
    n = polylines(embeddings).select("vec_id", geo.nearest(F.col("line"), F.col("p")).alias("n"))
    return n.select("vec_id", rounded(F.col("n.travelled"), 6).alias("travelled"), rounded(F.col("n.far"), 6).alias("far"))


LAMBERT = geo.lambert_steps("(SELECT c_custkey, 3.0 + (c_custkey % 300) / 100.0 AS x, 49.5 + (c_custkey % 200) / 100.0 AS y FROM customer)")


@query(f"SELECT c_custkey, round_even(lambert_x * 1e3, 0) / 1e3 AS x, round_even(lambert_y * 1e3, 0) / 1e3 AS y FROM ({LAMBERT})")
def latlon_to_lambert(customer):
    p = geo.point(3.0 + (F.col("c_custkey") % 300) / 100.0, 49.5 + (F.col("c_custkey") % 200) / 100.0)
    at = customer.select("c_custkey", geo.to_lambert(p).alias("at"))
    return at.select("c_custkey", rounded(F.col("at.x"), 3).alias("x"), rounded(F.col("at.y"), 3).alias("y"))


@query("SELECT c_custkey, round_even((3 + (c_custkey % 300) / 100.0) * 1e7, 0) / 1e7 AS x, round_even((49.5 + (c_custkey % 200) / 100.0) * 1e7, 0) / 1e7 AS y FROM customer")
def lambert_round_trip(customer):
    p = geo.point(3.0 + (F.col("c_custkey") % 300) / 100.0, 49.5 + (F.col("c_custkey") % 200) / 100.0)
    back = customer.select("c_custkey", geo.to_degrees(geo.to_lambert(p)).alias("back"))
    return back.select("c_custkey", rounded(F.col("back.x"), 7).alias("x"), rounded(F.col("back.y"), 7).alias("y"))


# Whole plans over the test tables


def snapshots(events) -> DataFrame:
    """Events as a catalog of GeoJSON snapshots, one a day, of users as moving points."""
    rows = events.select(day().alias("date"), F.col("user_id").cast("string").alias("uuid"), F.col("event_id").alias("pointId"), geo.point(F.col("value"), F.col("event_id")).alias("geometry"))
    once = ordering.first_of_group(rows, ["date", "uuid"], ["pointId"])
    return geojson.collections(once, ["date"], "uuid")


DAILY = "SELECT date_trunc('day', ts)::TIMESTAMP AS date, user_id::VARCHAR AS uuid, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY event_id) = 1"


@query(f"SELECT date, uuid, event_id AS \"pointId\", value AS x, event_id::DOUBLE AS y FROM ({DAILY})")
def geojson_round_trip(events):
    back = geojson.features(snapshots(events), "uuid string, pointId long")
    return back.select("date", "uuid", "pointId", "geometry.x", "geometry.y")


@query(f"""
SELECT uuid, count(*)::BIGINT AS n, string_agg(strftime(date, '%Y-%m-%dT%H:%M:%S.%fZ'), ',' ORDER BY date) AS datetimes FROM ({DAILY})
WHERE date > TIMESTAMP '2024-01-04' AND date < TIMESTAMP '2024-01-21' GROUP BY uuid HAVING count(*) > 1""")
def moving_features(events):
    start, end = (int((d - datetime(1970, 1, 1)).total_seconds()) for d in (datetime(2024, 1, 4), datetime(2024, 1, 21)))
    schema = "array<struct<properties:struct<uuid:string,pointId:bigint>,geometry:struct<coordinates:array<double>>>>"
    found = trajectories.trajectories(snapshots(events), schema, "uuid", start, end, drop=["pointId"])
    times = F.from_json(F.get_json_object("feature", "$.temporalGeometry.datetimes"), "array<string>")
    return found.select("uuid", F.size(times).cast("long").alias("n"), F.array_join(times, ",").alias("datetimes"))


def feed(orders, lineitem, supplier) -> dict[str, DataFrame]:
    """Orders as trips, their lines as stops in sequence, suppliers as places, priorities as services."""
    lines = ordering.first_of_group(lineitem, LINE, TIES)
    seconds = (F.col("l_orderkey") * 97 % 80000 + F.col("l_linenumber") * 600).cast("int")
    services = [("1-URGENT", "1111100"), ("2-HIGH", "0000011"), ("3-MEDIUM", "1111111"), ("4-NOT SPECIFIED", "1010101"), ("5-LOW", "0100000")]
    days = ", ".join(f"{d} string" for d in gtfs.DAYS)
    session = orders.sparkSession
    return {
        "trips": orders.select(F.col("o_orderkey").cast("string").alias("trip_id"), F.col("o_orderpriority").alias("service_id"), F.col("o_orderstatus").alias("trip_headsign")),
        "stop_times": lines.select(F.col("l_orderkey").cast("string").alias("trip_id"), F.col("l_suppkey").cast("string").alias("stop_id"), F.col("l_linenumber").alias("stop_sequence"), seconds.alias("arrival_time"), (seconds + 30).alias("departure_time")),
        "stops": supplier.select(F.col("s_suppkey").cast("string").alias("stop_id"), F.col("s_name").alias("stop_name"), F.col("s_acctbal").alias("stop_lat"), F.col("s_nationkey").cast("double").alias("stop_lon")),
        "calendar": session.createDataFrame([(s, *d, "20240101", "20241231") for s, d in services], f"service_id string, {days}, start_date string, end_date string"),
        "calendar_dates": session.createDataFrame([("2-HIGH", "20240103", "1"), ("3-MEDIUM", "20240103", "2")], "service_id string, date string, exception_type string"),
    }


# 3 January 2024, a Wednesday: the first and fourth service by weekday, the second added, the third removed.
TIMES = LINES + """,
times AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, o_orderstatus, (l_orderkey * 97 % 80000 + l_linenumber * 600)::INTEGER AS at
  FROM (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1)
  JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', '2-HIGH'))
"""


@query("SELECT o_orderkey::VARCHAR AS trip_id FROM orders WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', '2-HIGH')")
def service_date(orders, lineitem, supplier):
    return gtfs.on_date(feed(orders, lineitem, supplier), datetime(2024, 1, 3).date())["trips"].select("trip_id")


@query(TIMES + """
SELECT l_suppkey::VARCHAR AS stop_id, s_name AS stop_name, count(*)::BIGINT AS n,
       string_agg(l_orderkey || '@' || printf('%02d:%02d:%02d', "at" // 3600 % 24, "at" % 3600 // 60, "at" % 60) || o_orderstatus, ';' ORDER BY "at", l_orderkey::VARCHAR) AS schedule
FROM times JOIN supplier ON s_suppkey = l_suppkey WHERE "at" + 30 >= 8 * 3600 AND "at" <= 12 * 3600 GROUP BY ALL""")
def schedule(orders, lineitem, supplier):
    start = int((datetime(2024, 1, 3, 8) - datetime(1970, 1, 1)).total_seconds())
    found = gtfs.schedule(feed(orders, lineitem, supplier), start, start + 4 * 3600, "UTC")
    entry = lambda e: F.concat(e["trip_id"], F.lit("@"), e["arrival_time"], e["trip_headsign"])
    return found.select("stop_id", "stop_name", F.size("schedule").cast("long").alias("n"), F.array_join(F.transform("schedule", entry), ";").alias("schedule"))


@query(TIMES + """
SELECT a.l_orderkey::VARCHAR AS trip_id, a.l_linenumber AS stop_sequence, round_even((36000 - a.at) / (b.at - a.at) * 1e6, 0) / 1e6 AS percentage
FROM times a JOIN times b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.at < 36000 AND b.at > 36000""")
def trains_underway(orders, lineitem, supplier):
    times = gtfs.on_date(feed(orders, lineitem, supplier), datetime(2024, 1, 3).date())["stop_times"]
    return rail.underway(times, 36000).select("trip_id", "stop_sequence", rounded(F.col("percentage"), 6).alias("percentage"))


@query("""
SELECT date_trunc('day', ts)::TIMESTAMP AS date, event_type AS "lineId", event_id::VARCHAR AS "pointId", user_id::INTEGER AS "distanceFromPoint" FROM events
QUALIFY max((event_id % 97 = 0)::INTEGER) OVER (PARTITION BY date_trunc('day', ts), user_id) = 0""")
def validated_batch(events):
    # A user's day is a document, so that documents become more with the table and not longer; one of its items breaks the schema if its id is a multiple of 97.
    item = F.struct(
        F.col("event_type").alias("lineId"), F.when(F.col("event_id") % 97 != 0, F.col("event_id").cast("string")).alias("pointId"),
        F.when(F.col("event_id") % 97 == 0, F.lit("far")).alias("distanceFromText"), F.col("user_id").cast("int").alias("near"),
    )
    text_of = F.when(F.col("event_id") % 97 == 0, F.lit('{"distanceFromPoint":"far"}')).otherwise(F.regexp_replace(F.to_json(item), '"near"', '"distanceFromPoint"'))
    documents = events.select(day().alias("date"), "user_id", text_of.alias("item")).groupBy("date", "user_id").agg(F.concat(F.lit("["), F.array_join(F.collect_list("item"), ","), F.lit("]")).alias("data"))
    items, _ = compaction.batch(documents, "struct<lineId:string,pointId:string,distanceFromPoint:int>", {"pointId": "string", "distanceFromPoint": "integer"}, "lineId")
    return items.select("date", "lineId", "pointId", "distanceFromPoint")


@query(SEGMENTS + "SELECT vec_id, round_even(0.5 * sum(size) * 1e6, 0) / 1e6 AS length FROM measured GROUP BY vec_id")
def line_part(embeddings):
    measured = polylines(embeddings).withColumn("whole", geo.length(F.col("line")))
    cut = measured.select("vec_id", geo.part(F.col("line"), 0.25 * F.col("whole"), 0.75 * F.col("whole")).alias("part"))
    return cut.select("vec_id", rounded(geo.length(F.col("part")), 6).alias("length"))


@query("""
SELECT c_custkey::VARCHAR AS icao24, c_name AS callsign, CASE c_custkey % 5 WHEN 0 THEN 'ADS-B' WHEN 1 THEN 'ASTERIX' WHEN 2 THEN 'MLAT' WHEN 3 THEN 'FLARM' END AS position_source, c_acctbal AS x
FROM customer WHERE c_custkey % 3 <> 0 AND c_acctbal BETWEEN 0 AND 5000""")
def aircraft_states(customer):
    cell = lambda c: c.cast("string")
    empty = F.lit(None).cast("string")
    vector = F.array(
        cell(F.col("c_custkey")), F.concat(F.lit(" "), "c_name", F.lit(" ")), *[empty] * 3, F.when(F.col("c_custkey") % 3 != 0, cell(F.col("c_acctbal"))), F.lit("50.5"), *[empty] * 9, cell(F.col("c_custkey") % 5)
    )
    payloads = customer.groupBy(F.floor(F.col("c_custkey") / 100).alias("part")).agg(F.to_json(F.struct(F.collect_list(vector).alias("states"))).alias("data"))
    return feeds.aircraft(payloads, (0, 50, 5000, 51)).select("icao24", "callsign", "position_source", "geometry.x")


def catalog_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends the events to a new catalog, payloads stored once, and reads them back."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    catalog = Catalog(spark, compaction.shared_folder(spark, "catalog"))
    catalog.append("events", events.select(F.col("ts").alias("date"), F.col("props").alias("data")))
    return catalog.read("events").select("id", "date", "data")


QUERIES["catalog_write_read"] = catalog_write_read
SQL["catalog_write_read"] = "SELECT row_number() OVER (ORDER BY ts)::BIGINT AS id, ts AS date, props AS data FROM events"


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event counts by week and type from a stream that is run until its input is used up."""
    folder = compaction.shared_folder(spark, "stream")
    source = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")
    source.write.parquet(f"{folder}/in")
    count = lambda rows: rows.groupBy(time.bucket(F.col("ts"), timedelta(weeks=1)).alias("week"), "event_type").agg(F.count("*").alias("n"))
    runner.stream(spark.readStream.schema(source.schema).parquet(f"{folder}/in"), count, f"{folder}/out", f"{folder}/check").awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("week", "event_type").agg(F.sum("n").alias("n"))


QUERIES["stream_totals"] = stream_totals
SQL["stream_totals"] = "SELECT date_trunc('week', ts)::TIMESTAMP AS week, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL"


@query()
def identify_vehicles(events):
    """Events as observations of vehicles: a line a user, a direction a kind of event, metres from the value; day by day."""
    first = time.moment(datetime(2024, 1, 1))
    rows = events.select(
        F.col("event_id").alias("row_id"), F.col("user_id").cast("string").alias("lineId"), F.when(F.col("event_type") == "click", 1).otherwise(2).alias("direction"),
        F.timestamp_diff("SECOND", first, F.col("ts")).cast("double").alias("timestamp"), (F.col("value") * 100).alias("distance"), F.lit(None).cast("string").alias("uuid"),
    )
    return identify.identify(rows, seconds=86400.0)
