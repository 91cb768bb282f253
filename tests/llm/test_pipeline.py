import pytest

import corpus_pipeline as P
from test_decontaminate import LONG, brute
from test_simhash import brute_print
from tramlake.llm import decontaminate, mixing, simhash


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = first = P.table(spark, sf_dir, "documents")
    kept = []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(path)
        kept.append(docs.count())
        if k < len(P.STAGES) - 1:
            assert docs.columns == first.columns
            assert docs.exceptAll(before).count() == 0
        if name == "SimHash near-dedup":
            want = simhash.near_duplicates(before).select("component_id").distinct()
            assert docs.select("doc_id").exceptAll(want).count() == want.exceptAll(docs.select("doc_id")).count() == 0
        if name == "benchmark decontamination":
            found = decontaminate.query(before, P.table(spark, sf_dir, "benchmark"))
            assert docs.select("doc_id").exceptAll(found.where("not contaminated").select("doc_id")).count() == 0
            assert kept[-1] == found.where("not contaminated").count() < before.count()
        if name == "mixing sources":
            want = mixing.query(before)
            assert docs.select(want.columns).exceptAll(want).count() == 0
            words = docs.selectExpr("taken", "aggregate(copies, 0L, (s, c) -> s + c.words) AS words").collect()
            assert all(r.taken == r.words for r in words)
    assert kept[0] >= 0.99 * first.count() and all(a >= b for a, b in zip(kept, kept[1:], strict=False))
    labels = P.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").count()
    assert kept[1] > 0.8 * first.count() and labels
    assert P.run(spark, sf_dir).exceptAll(docs).count() == 0


def brute_kept(name, rows, items):
    """The stage's rule on the rows, where it needs no training."""
    if name == "SimHash near-dedup":
        prints = [brute_print(r["text"]) for r in rows]
        label = list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    label = [label[b] if x == label[a] else x for x in label]
        groups = {}
        for r, p, x in zip(rows, prints, label, strict=True):
            groups.setdefault(x, []).append((r["doc_id"] is None, r["doc_id"] or 0, p - (1 << 64) if p >> 63 else p, r))
        return {x: [r for *k, r in g if k == list(min(g, key=lambda v: v[:3])[:3])] for x, g in groups.items()}
    return [r for r in rows if not brute([(r["doc_id"], r["text"])], items)[0][5]]


@pytest.mark.parametrize("stage", range(5))
def test_odd_rows(spark, tmp_path, stage):
    """Nulls in every column, empty and long texts, repeated rows, shared ids, clashing columns, empty tables."""
    name, run = P.STAGES[stage]
    prose = ["the of and word that is here", "der die und wort das ist hier", "words of another text are there"]
    rows = [(k, f"{prose[k % 2]} number {k} " * 6, ["en", "de"][k % 2], f"s{k % 3}") for k in range(40)]
    rows += [(100, None, "en", "s1"), (101, "", None, None), (None, " \n ", None, "s1"), (None, prose[0], "en", None), (7, prose[2] * 3, "en", "s1"), (7, prose[1], "de", "s2")]
    rows += [(200, prose[0] * 20_000, "en", "s1"), (201, LONG, None, "s0"), *[(300, prose[2], "en", "s1")] * 3, (301, "12 !?", "en", "s1")]
    kinds = "doc_id long, text string, lang string, source string, row int, `a.b` int, fp string, taken int, hash double"
    docs = spark.createDataFrame([(*r, 1, k % 2, None, None, 0.5) for k, r in enumerate(rows)], kinds)
    items = [(1, LONG), (2, None), (3, "")]
    sf = str(tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, 0), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    out = run(spark, docs, sf)
    got = [r.asDict(recursive=True) for r in out.collect()]
    given = [r.asDict() for r in docs.collect()]
    assert run(spark, docs.limit(0), sf).count() == 0
    if stage == 4:
        assert len(got) == len(rows) and sum(r["taken"] for r in got) > 0 and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        return
    assert out.columns == docs.columns and all(r in given for r in got)
    texts = [r["text"] for r in got]
    if name == "language ID":
        assert not {None, "", " \n ", "12 !?"} & {*texts} and texts.count(prose[2]) == 3 and prose[0] * 20_000 in texts
    if name == "quality classifier":
        assert texts.count(prose[2]) in (0, 3)
    if name == "SimHash near-dedup":
        want = brute_kept(name, given, items)
        assert len(got) == len(want) and all(any(r in own for r in got) for own in want.values())
    if name == "benchmark decontamination":
        assert sorted(got, key=repr) == sorted(brute_kept(name, given, items), key=repr) and len(got) == len(rows) - 1
