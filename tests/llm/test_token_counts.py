import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tramlake.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
SPECIAL = T.loaded(open(PATH, "rb").read())[1]
ODD = [
    "", " ", "a\x1cb c\x85d e f ́x  é <|endoftext|>a<|startoftext|> <|ENDOFTEXT|>'s'S don't\x0b\x0cq", "ΑΣ ΑΣ. ΣΑΣ İi ﬃ \x01 12 3a4 日本 語　x",
    "<|endoftext|>", "x" * 5000, "à́ ́̀ b", "﻿ a​b", "½²³ ١٢", "it's we'll I'D\n\n\ty",
]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False))


def counts(texts):
    """Tokens of each text by block(), without Spark."""
    tokens, place, n, begin = T.block(pa.array(texts, pa.string()), T.Splitter(LIBRARY, SPECIAL))
    sizes = np.array([T.pieces(LIBRARY, t) for t in tokens], np.int64)
    return T.totals(*T.frequencies(place, n, begin), sizes).tolist()


def test_odd_texts_as_the_library_counts_them():
    assert counts(ODD) == [library(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\r\x0b\x0c'<|>aé")), max_size=60))
def test_any_text_as_the_library_counts_it(text):
    assert counts([text, "", text + " " + text]) == [library(text), 0, library(text + " " + text)]


def test_high_frequencies_and_bounded_memory_change_nothing(monkeypatch):
    texts = [f"w{k} w{k % 7} some words {'long' * 30}" for k in range(200)] + ["a b " * 5000]
    want = [library(t) for t in texts]
    monkeypatch.setattr(T, "KEPT", 10)
    monkeypatch.setattr(T, "AT_ONCE", 7)
    assert counts(texts) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 50), max_size=5), max_size=6))
def test_packed_numbers_come_back(lists):
    begin = np.cumsum([0, *map(len, lists)])
    values, again = T.unpacked(T.packed(np.array([x for v in lists for x in v], np.int64), begin))
    assert values.tolist() == [x for v in lists for x in v] and again.tolist() == begin.tolist()


def test_a_pre_token_is_one_entry_of_a_text():
    _, place, n, begin = T.block(pa.array(["it's it's, it", "", "it"]), T.Splitter(LIBRARY, SPECIAL))
    assert begin.tolist() == [0, 3, 3, 4] and sorted(n.tolist()) == [1, 1, 2, 3]


def test_tokenizers_that_carry_white_space_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="white space"):
        T.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def test_blocks_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    assert sorted(T.count_tokens(docs, path, block_text=3000).collect()) == sorted(T.count_tokens(docs, path).collect())


def test_each_distinct_pre_token_is_counted_once(spark, sf, tmp_path, monkeypatch):
    docs, log = spark.read.parquet(f"{sf}/documents.parquet"), str(tmp_path / "log")
    count = T.pieces

    def logged(tokenizer, token):
        with open(log, "a") as file:
            file.write(token + "\n")
        return count(tokenizer, token)

    monkeypatch.setattr(T, "check", lambda *_: None)
    monkeypatch.setattr(T, "pieces", logged)
    got = T.count_tokens(docs, PATH, block_text=20_000).collect()
    counted = open(log).read().split("\n")[:-1]
    monkeypatch.setattr(T, "pieces", count)
    assert len(counted) == len({*counted}) > 1000 and sorted(got) == sorted(T.query(docs).collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcé", min_size=1, max_size=3), unique=True, min_size=1), st.integers(1, 9))
def test_dealt_lists_keep_every_place(tokens, buckets):
    bucket, texts, places = T.dealt(tokens, buckets)
    step, begin = T.unpacked(places)
    back = {int(p): t for k, text in enumerate(texts) for p, t in zip(np.cumsum(step[begin[k] : begin[k + 1]]), text.split("\n"), strict=True)}
    assert [back[k] for k in range(len(tokens))] == tokens and len({*bucket.tolist()}) == len(bucket)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = T.query(docs).collect()
    assert len(got) == len(text)
    for r in got:
        n = library(text[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 2048)


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "a b", 0), (2, "a b", 0), (None, "a", 0)], "doc_id long, text string, n_tokens int")
    assert sorted(map(tuple, T.query(docs).collect()), key=repr) == sorted([(1, 0, 0, False), (2, 3, 2, False), (2, 3, 2, False), (None, 1, 1, False)], key=repr)
    assert T.query(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        T.FILE_BYTES, kept = 10, T.FILE_BYTES
        try:
            T.query(docs)
        finally:
            T.FILE_BYTES = kept
