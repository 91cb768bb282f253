import zlib

import numpy as np

from tramlake.llm import quality as Q

DATA = "/root/testdata/sf0.1"


def area(score, label):
    """Area under the ROC curve."""
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    found = Q.query(docs, labels).toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all()
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]
    held = found[found.held_out].merge(labels.toPandas(), on="doc_id")
    assert area(held.score.to_numpy(), held.quality.to_numpy()) > 0.99
    assert (held.predicted == held.quality).mean() > 0.98
    again = Q.query(docs.repartition(7), labels.repartition(3)).toPandas()
    assert again.sort_values("doc_id").score.tolist() == found.sort_values("doc_id").score.tolist()


def test_one_update_by_hand():
    # One feature of value 1 and the bias, label 1: both get the gradient -1/2 and the same weight.
    w = Q.fit([((np.array([5]), np.array([1.0])), 1.0)])
    want = (0.5 - Q.L1) / ((Q.BETA + 0.5) / Q.ALPHA + Q.L2)
    assert np.allclose(w[[5, -1]], want) and np.count_nonzero(w) == 2


def test_pieces_of_a_long_text_give_the_same_vector(monkeypatch):
    import tramlake.llm.common as C

    text = ("Some words, repeated repeated words!! " * 60).encode()
    whole = Q.vector(text, {})
    monkeypatch.setattr(Q, "text_blocks", lambda data: C.text_blocks(data, 40))
    for a, b in zip(whole, Q.vector(text, {}), strict=True):
        assert np.allclose(a, b)


def test_the_sample_has_one_document_and_label_an_id(spark, monkeypatch):
    docs = [(k, f"words of text {k}") for k in range(1, 40)]
    labels = [(k, k % 2) for k in range(1, 40)]
    monkeypatch.setattr(Q, "PASSES", 1)
    frame = lambda rows, kinds: spark.createDataFrame(rows, kinds).repartition(3)
    want = Q.train(frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, quality int"))
    again = Q.train(frame([*docs, *[docs[4]] * 500], "doc_id long, text string"), frame(labels + [labels[4]] * 300, "doc_id long, quality int"))
    assert (want == again).all()
    # Documents and labels that share an id: a mean label, and the same document whatever the order.
    odd = [frame([*docs, *((5, f"other {k}") for k in range(n))][::step], "doc_id long, text string") for n, step in ((50, 1), (50, -1))]
    both = [Q.train(d, frame([*labels, (5, 0)], "doc_id long, quality int")) for d in odd]
    assert (both[0] == both[1]).all()


def test_nulls_empty_texts_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "good words here", 0), (3, "good words here", 0), (None, "x", 0), (9, "bad ***", 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (9, 0), (None, 1), (1, None), (3, 1)], "doc_id long, quality int")
    got = Q.query(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert {r.score for r in Q.query(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.query(docs.limit(0), labels).count() == 0
    assert Q.good(docs, labels.limit(0)).columns == docs.columns and Q.good(docs, labels.limit(0)).count() == 6
