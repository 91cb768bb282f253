import re
from collections import defaultdict

import pytest

from tramlake.llm import mixing as M


def brute(rows):
    """Targets by sharing and resharing, until no source is above twice its size."""
    size = defaultdict(int)
    for _, source, text in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, free = 1.5 * sum(size.values()), set(order)
    while True:
        rest = budget - sum(2 * size[s] for s in order if s not in free)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            return size, {s: share.get(s, 2.0 * size[s]) for s in order}
        free -= over


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    size, target = brute(rows)
    source, got, taken = {i: s for i, s, _ in rows}, M.query(docs).collect(), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in target)
    assert sorted(map(tuple, got)) == sorted(map(tuple, M.query(docs.repartition(3)).collect()))


def test_small_and_uneven_sources(spark):
    rows = [(k, "big", "w " * (k % 7)) for k in range(300)] + [(1000 + k, f"s{k % 9}", "x y z " * (k % 5 + 1)) for k in range(40)]
    check(spark, rows + [(2000, None, "a b c"), (2001, None, None), (2002, "é", "q\x0bq q"), (2003, "Z", "word " * 900), (2004, "empty", "")])


def test_tables(spark, sf):
    check(spark, [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_one_source_gets_its_share_alone(spark):
    check(spark, [(k, "only", "a b c d") for k in range(10)])


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "x y")] * 4 + [(2, "b", "")], "doc_id long, source string, text string")
    assert M.query(docs).count() == 5 and M.query(docs).groupBy().sum("taken").first()[0] == 12
    assert M.query(docs.limit(0)).count() == 0
    assert {r.target for r in M.query(docs.where("doc_id = 2")).collect()} == {0.0}


def test_order_is_that_of_words_by_virtual_time(spark):
    """Against the words themselves, one by one: each has a virtual time, and the first of them up to the budget are taken."""
    rows = [(k, "abc"[k % 3], "w " * (k * 7 % 11)) for k in range(60)] + [(100, "d", "x y z"), (101, "e", "v " * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    copies = M.served(docs).collect()
    words = sorted(((r.start + k + 1) / r.weight, r.source, r.doc_id) for r in copies for k in range(r.size))
    budget = int(1.5 * sum(len(t.split()) for _, _, t in rows))
    taken = defaultdict(int)
    for _, source, _ in words[:budget]:
        taken[source] += 1
    got = defaultdict(int)
    for r in copies:
        got[r.source] += r.taken
    assert all(abs(got[s] - taken[s]) <= 1 for s in "abcde") and budget - 5 <= sum(got.values()) <= budget


def test_training_order_follows_virtual_time(spark):
    docs = spark.createDataFrame([(k, "ab"[k % 2], "w w w") for k in range(50)], "doc_id long, source string, text string")
    out = [r.virtual_finish for r in M.training_order(docs).collect()]
    assert out == sorted(out) and out


def test_training_order_has_every_copy(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = M.mix(docs).collect()
    monkeypatch.setattr(M, "ROWS", 10)  # more digits and ranges change nothing
    out = M.training_order(docs).collect()
    assert [r.virtual_finish for r in out] == sorted(r.virtual_finish for r in out)
    taken, upto, copies = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in out:
        taken[r.doc_id] += r.taken
        copies[r.doc_id].append((r.virtual_finish, r.taken))
        assert r.start == upto[r.source] and r.virtual_finish == (r.start + r.taken) / r.weight
        upto[r.source] += r.taken
    assert {r.doc_id: r.taken for r in mixed if r.taken} == taken
    assert {r.doc_id: [tuple(c) for c in r.copies] for r in mixed if r.copies} == copies
    assert all(upto[r.source] == int(r.target) for r in out) and any(r.copy == 1 for r in out)
    assert max(r.virtual_finish for r in out) <= max(r.target / r.weight for r in out)


def test_plan_is_native(spark, sf):
    plan = M.query(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
