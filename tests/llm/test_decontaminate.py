import re
from hashlib import sha256

import pytest

from tramlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((doc_id, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{k}" for k in range(40))
ITEMS = [(1, LONG), (2, "Tiny item"), (3, "one"), (4, None), (5, " -- "), (10, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18"), (1, LONG), (7, "x " * 20), (8, "É a é A b")]
DOCS = [
    (1, LONG), (2, LONG.upper() + "!"), (3, None), (4, ""), (5, "..."), (6, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (7, "a tiny, ITEM here"), (8, "one\none one"),
    (9, "z " * 300 + LONG), (10, "w0-w1 " + LONG[20:] + " " + LONG[:60]), (11, "x " * 500), (12, "É a é a b"), (13, "é a é a b"), (1, LONG), (14, "oné"), (None, "tiny item"),
]


def table(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


@pytest.mark.parametrize(("block", "shard"), [(D.BLOCK_TEXT, D.SHARD_TEXT), (60, 100)])
def test_against_brute_force(spark, block, shard):
    found = D.find(table(spark, DOCS, "doc_id"), table(spark, ITEMS, "item_id"), ["doc_id"], block, shard).collect()
    got = [(r.row.doc_id, r.n_words, r.n_hit, len(r["items"]), sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in found]
    assert sorted(got, key=repr) == brute(DOCS, ITEMS)


def test_query_on_the_tables(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = [tuple(r) for r in D.query(docs, items).collect()]
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(r[-1] for r in got)


def test_longest_match_and_place(spark):
    r = D.find(table(spark, [(1, "a b " + LONG + " c")], "doc_id"), table(spark, ITEMS[:1], "item_id")).first()
    assert (r.longest.words, r.longest.item, r.longest.at) == (40, "1", 2)
    assert [tuple(x) for x in r.spans] == [(2, 42)]


def test_one_map_whatever_the_number_of_blocks(spark):
    docs, items = table(spark, DOCS, "doc_id"), table(spark, ITEMS, "item_id")
    assert sum(1 for _ in D.query_blocks(items, 60)) > 3
    for block in (D.BLOCK_TEXT, 60):
        out = D.find(docs, items, ["doc_id"], block, 100, 200)
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        got = [(r.row.doc_id, r.n_words, r.n_hit, len(r.items), sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in out.collect()]
        assert sorted(got, key=repr) == brute(DOCS, ITEMS)


def test_remove_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, LONG, 1, 2, 3), (2, "clean", 4, 5, 6)], "doc_id long, text string, spans int, row int, `n.words` int")
    left = D.remove(docs, table(spark, ITEMS, "item_id"))
    assert left.columns == docs.columns
    assert [tuple(r) for r in left.collect()] == [(2, "clean", 4, 5, 6)]


def test_empty_tables(spark):
    none, docs = table(spark, [], "item_id"), table(spark, DOCS, "doc_id")
    assert not any(r.contaminated or r.n_items for r in D.query(docs, none).collect())
    assert D.query(table(spark, [], "doc_id"), table(spark, ITEMS, "item_id")).count() == 0


def test_words_of_a_very_long_text():
    from tramlake.llm.common import word_blocks

    text = b"ab cd  e " * 300
    assert [w for part in word_blocks(text, 50) for w in part] == text.split()
    assert [*word_blocks(b"x" * 500, 50)] == [[b"x" * 500]]
