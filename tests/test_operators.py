import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tramlake.operators import asof, matching, ordering, statistics

T0 = datetime(2024, 1, 1)


def times(spark, n, step=3600):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=step * k)) for k in range(n)], "k long, t timestamp_ntz")


def test_reads_are_strict(spark):
    df = times(spark, 5)
    at = T0 + timedelta(hours=2)
    keys = lambda x: [r.k for r in x.collect()]
    assert keys(ordering.newest(df, "t")) == [4] and keys(ordering.oldest(df, "t")) == [0]
    assert keys(ordering.after(df, "t", at, 1)) == [4] and keys(ordering.before(df, "t", at)) == [1, 0]
    assert keys(ordering.between(df, "t", T0, at)) == [1] and keys(ordering.between(df, "t")) == [0, 1, 2, 3, 4]
    assert sorted(keys(ordering.within(df, "t", T0, at))) == [0, 1, 2]


def test_numbers_are_those_of_one_global_order(spark):
    df = times(spark, 200, 1000).repartition(7)
    got = ordering.numbered(df, ["t"], F.date_trunc("day", "t")).collect()
    assert all(r.n == r.k + 1 for r in got) and len(got) == 200


def test_null_and_equal_times_are_numbered(spark):
    df = spark.createDataFrame([(0, None), (1, None), *((k, T0 + timedelta(days=k // 4)) for k in range(2, 30))], "k long, t timestamp_ntz").repartition(5)
    got = {r.k: r.n for r in ordering.numbered(df, ["t"], F.date_trunc("day", "t")).collect()}
    assert sorted(got.values()) == list(range(1, 31)) and {got[0], got[1]} == {1, 2} and all(got[a] < got[b] for a in got for b in got if a // 4 < b // 4 and a > 1)


def test_first_other_against_all_pairs(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None])) for i in range(40)]
    right = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), i, f"v{i % 4}") for i in range(25)]
    a, b = spark.createDataFrame(left, "i int, k string, d int"), spark.createDataFrame(right, "rk string, rd int, at int, v string")
    got = {r.i: (r.rd, r["at"], r.v) for r in matching.first_other(a, b, {"k": "rk"}, ("d", "rd"), ["at"]).collect()}
    want = {i: min(((d2, at, v) for k2, d2, at, v in right if k is not None and k == k2 and None not in (d, d2) and d != d2), key=lambda x: x[1], default=(None,) * 3) for i, k, d in left}
    assert got == want


def test_deltas_over_days(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), T0 + timedelta(hours=h), float(h * h % 17) if h % 5 else None) for h in rng.sample(range(400), 90)]
    got = {(r.k, r.t): r.delta for r in statistics.deltas(spark.createDataFrame(rows, "k string, t timestamp_ntz, v double"), "k", "t", "v").collect()}
    want = {}
    for k in ("a", "b", None):
        own = sorted((t, v) for x, t, v in rows if x == k)
        want |= {(k, t): None if n == 0 or v is None or own[n - 1][1] is None else v - own[n - 1][1] for n, (t, v) in enumerate(own)}
    assert got == want


def test_count_windows(spark):
    df = times(spark, 7).union(times(spark, 7))
    got = sorted({(r.k, r.window, r.place) for r in ordering.count_windows(df, "t", F.date_trunc("day", "t"), 3).collect()})
    assert got == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 1, 1), (4, 1, 2), (5, 1, 3)]
    assert ordering.count_windows(df, "t", F.date_trunc("day", "t"), 3, strict=False).count() == 14


def test_zip_ends_with_the_shorter(spark):
    a, b = times(spark, 5).withColumnRenamed("k", "a").withColumnRenamed("t", "s"), times(spark, 3, 60)
    day = lambda c: F.date_trunc("day", c)
    assert sorted((r.a, r.k) for r in ordering.zipped(a, b, ["s"], ["t"], day("s"), day("t")).collect()) == [(0, 0), (1, 1), (2, 2)]


def brute_asof(left, right, n):
    out = []
    for k, t, i in left:
        seen = sorted((u, v) for j, u, v in right if j == k and u < t)[::-1][:n]
        out.append((i, [v for _, v in seen]))
    return sorted(out)


def test_asof_against_brute_force(spark):
    rng = random.Random(5)
    moment = lambda: T0 + timedelta(hours=rng.randrange(200))
    left, right = [(rng.randrange(4), moment(), i) for i in range(150)], [(rng.randrange(3), moment(), i) for i in range(120)]
    a, b = spark.createDataFrame(left, "key long, t timestamp_ntz, i long"), spark.createDataFrame(right, "key long, u timestamp_ntz, v long")
    want = brute_asof(left, right, 3)
    one = {r.i: r.v for r in asof.asof(a, b, ["key"], "t", "u", ["v"]).collect()}
    assert one == {i: v[0] if v else None for i, v in want}
    several = {}
    for r in asof.asof_last_n(a, b, ["key"], "t", "u", ["v"], 3).collect():
        several.setdefault(r.i, {})[r.age] = r.v
    assert several == {i: dict(enumerate(v, 1)) for i, v in want if v}
    latest = max((u, v) for _, u, v in right)
    got = {r.i: r.v for r in asof.asof_or_latest(a, b, ["key"], "t", "u", "v").collect()}
    assert all(got[i] == (v[0] if v else got[i]) for i, v in want) and all(right[got[i]][1] == latest[0] for i, v in want if not v)


def test_asof_ties(spark):
    left = spark.createDataFrame([("a", T0)], "key string, t timestamp_ntz")
    right = spark.createDataFrame([("a", T0 + timedelta(hours=h), h) for h in (-1, 0, 1)], "key string, u timestamp_ntz, v int")
    assert asof.asof(left, right, ["key"], "t", "u", ["v"]).first().v == -1
    none = right.where("v >= 0")
    assert asof.asof(left, none, ["key"], "t", "u", ["v"]).first().v is None
    assert asof.asof_or_latest(left, none, ["key"], "t", "u", "v").first().v == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert [r.v for r in ordering.unique_keys(df, ["k"]).collect()] == ["c"]
    assert sorted(r.v for r in ordering.several(df, ["k"]).collect()) == ["a", "b"]
    assert sorted(r.v for r in ordering.first_of_group(df, ["k"], [F.col("v").desc()]).collect()) == ["b", "c"]


def test_successor_does_not_bridge_gaps(spark):
    df = spark.createDataFrame([("t", 1, "a"), ("t", 2, "b"), ("t", 4, "d")], "k string, n int, s string")
    assert [(r.s, r.s_next) for r in matching.with_successor(df, "k", "n", ["s"]).collect()] == [("a", "b")]


def test_copies_and_tombstones(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, None)], "id long, data string")
    stored = matching.point_to_copies(rows.where("data IS NOT NULL"), "id", "data")
    assert {r.id: (r.data, r.copy_id) for r in stored.collect()} == {1: ("x", None), 2: ("y", None), 3: (None, 1)}
    assert {r.id: (r.data, r.hash, r.copy_id) for r in matching.point_to_copies(rows.union(rows.selectExpr("id + 10", "data")), "id", "data").where("id IN (4, 14)").collect()} == {4: (None,) * 3, 14: (None,) * 3}
    back = matching.resolve_copies(stored)
    assert {r.id: r.data for r in back.collect()} == {1: "x", 2: "y", 3: "x"}
    lost = spark.createDataFrame([(1, None, None, 9), (2, None, None, None)], "id long, data string, hash string, copy_id long")
    assert [r.id for r in matching.without_tombstones(lost).collect()] == [1] and matching.resolve_copies(lost).first().data is None


def test_pair_speed_by_hand(spark):
    rows = [(d, k, v) for k, vs in {"a": [0, 100, 150, 500], "b": [50, 40, 40, 90], None: [0, 36, 0, 0]}.items() for d, v in enumerate(vs)] + [(1, "c", 5.0), (0, "c", 0.0), (0, "c", 1.0)]
    df = spark.createDataFrame([(T0 + timedelta(seconds=20 * d), k, float(v)) for d, k, v in rows], "t timestamp_ntz, k string, v double")
    pairs = ordering.count_windows(df, "t", F.date_trunc("day", "t"), 2)
    got = statistics.pair_speed(pairs, ["k"], "place", "v", F.timestamp_diff("SECOND", F.col("then.t"), F.col("now.t")))
    assert sorted(((r.window, r.k, r.speed) for r in got.collect()), key=repr) == sorted([(0, "a", 18.0), (1, "a", 63.0), (1, "b", 9.0), (0, None, 6.48)], key=repr)


@pytest.mark.parametrize(("values", "want"), [([3.0, 3.0], [0.0, 0.0]), ([1.0, 2.0, 5.0], [0.0, 0.25, 1.0])])
def test_normalised(spark, values, want):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    assert sorted(r.n for r in statistics.normalised(df, ["k"], "v", "n").collect()) == want


def test_fallback_needs_a_single_match(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (4, "q", "z")], "id int, p string, l string")
    exact = spark.createDataFrame([("a", "x", "AX")], "p string, l string, v string")
    loose = spark.createDataFrame([("x", "X"), ("y", "Y1"), ("y", "Y2")], "l string, v string")
    got = matching.match_or_fall_back(rows, exact, loose, "id", ["p", "l"], ["l"], "v")
    assert sorted(map(tuple, got.collect())) == [(1, "AX", 5), (2, "X", 4)]
