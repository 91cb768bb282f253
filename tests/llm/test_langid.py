import os
import zlib

import numpy as np
import pytest

from tramlake.llm import langid as L

DATA = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = L.query(docs).toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all()
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]
    held = found[found.held_out].merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.995
    assert found.ambiguous.mean() < 0.002


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 20])
def test_codewords_differ_and_split(n):
    code = L.codewords(n)
    assert set(np.unique(code)) == {-1.0, 1.0} and (np.abs(code.sum(axis=0)) < n).all()
    apart = (code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(n)
    assert apart.min() >= (2 ** (n - 2) if n <= 5 else 5)


def test_a_wrong_bit_is_corrected():
    code = L.codewords(4)
    model = {"names": list("abcd"), "code": code, "w": np.eye(7), "b": np.zeros(7), "trust": np.full(code.shape, 1 / 7)}
    x = code * 3.0
    x[np.arange(4), np.arange(4)] *= -0.5
    names, score, ambiguous = L.decode(model, x)
    assert names == list("abcd") and not ambiguous.any() and (score > 0.5).all()
    assert L.decode(model, np.zeros((1, 7)))[2].all()


def test_pieces_of_a_long_text_count_alike(monkeypatch):
    import tramlake.llm.common as C

    text = "Ein Text über vieles, und noch mehr Wörter! " * 50
    whole = L.ngram_counts(text)
    monkeypatch.setattr(L, "text_blocks", lambda data: C.text_blocks(data, 30))
    # Each cut adds a space at both sides, as a word's neighbours have anyway.
    assert np.abs(whole - L.ngram_counts(text)).sum() <= 4 * 100


ROWS = [(k, " ".join(["the of and word"] * (k % 5 + 1)), "en") for k in range(60)] + [(100 + k, " ".join(["der die und wort"] * (k % 5 + 1)), "de") for k in range(60)]


def test_texts_without_letters_nulls_and_repeats(spark):
    rows = [*ROWS, (300, None, "en"), (301, "", "en"), (302, "12 !? ²", "de"), (303, "the and of", None), (303, "the and of", None), (None, "der und die", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in L.query(docs).collect():
        assert got.setdefault(r.doc_id, r) == r
    assert {got[i].lang_pred for i in (300, 301, 302)} == {"und"}
    assert got[303].lang_pred == "en" and got[None].lang_pred == "de"
    assert sorted(x for x in (r.doc_id for r in L.known(docs).collect()) if x is not None and x >= 300) == [303, 303]


def test_one_language_none_and_empty_tables(spark):
    docs = spark.createDataFrame(ROWS[:60], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.query(docs).collect()} == {"en"}
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "1 AS `a.b`")
    assert {r.lang_pred for r in L.query(unlabelled).collect()} == {"und"}
    assert L.known(unlabelled).columns == unlabelled.columns
    assert L.query(docs.limit(0)).count() == 0


def test_the_sample_does_not_reach_the_driver(spark, monkeypatch):
    fit = L.fit
    monkeypatch.setattr(L, "fit", lambda x, lang: fit(x, lang) | {"by": os.getpid(), "rows": len(lang)})
    model = L.train(spark.createDataFrame(ROWS[:60], "doc_id long, text string, lang string"))
    assert model["by"] != os.getpid() and model["rows"] == sum(zlib.crc32(str(r[0]).encode()) % 4 != 2 for r in ROWS[:60])


def test_many_languages_have_a_row_each(spark, monkeypatch):
    rows = [(k, f"{'abcdefghij'[k % 10] * 3} {'klmnopqrst'[k % 10] * 4} word{k}", f"l{k % 10}") for k in range(200)] + [(1000 + k, "zzz yyyy xx", "rare") for k in range(1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(L, "TRAIN_ROWS", 20)
    model = L.train(docs)
    assert model["names"] == sorted({r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2})
    again = L.train(docs.union(docs.where("doc_id = 7").crossJoin(spark.range(500)).drop("id")))
    assert again["names"] == model["names"]
    monkeypatch.setattr(L, "LANGUAGES", 5)
    with pytest.raises(ValueError):
        L.train(docs)
