import re

import numpy as np
import pytest
import xxhash

from tramlake.llm import simhash as S


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    low = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        low[x] = min((i for i in (low.get(x), doc_id) if i is not None), default=None)
    return sorted(((i, f"{p:016x}", low[x]) for (i, _), p, x in zip(rows, prints, label, strict=True)), key=repr)


BASE = [f"word{k}" for k in range(400)]
ROWS = (
    [(k, " ".join(BASE[:k] + ["changed"] + BASE[k + 1 :])) for k in range(5, 60, 3)]
    + [(100, None), (101, ""), (102, " \n\t"), (103, "a"), (104, "A"), (105, "a b c d"), (106, "é É x\x0by"), (105, "a b c d"), (None, "a"), (None, "only here"), (200, "\xa0x  y z q")]
)


@pytest.mark.parametrize("tree", [S.TREE, 3])
def test_against_brute_force(spark, sf, tree):
    rows = ROWS + [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in S.near_duplicates(docs, tree).collect()]
    assert sorted(got, key=repr) == brute_groups(rows)
    if tree == S.TREE:
        assert sorted((tuple(r) for r in S.query(docs).collect()), key=repr) == sorted(got, key=repr)


def clusters(seed, n=150):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    near = [base]
    for _ in range(6):
        near.append(near[-1] ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)))
    out = np.unique(np.concatenate(near))
    rng.shuffle(out)
    return out


def brute_labels(fps):
    label = np.arange(len(fps))
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= 4) for f in fps]
    while True:
        new = np.array([label[x].min() for x in near])
        if (new == label).all():
            return label
        label = new


def test_tree_lookup_finds_every_link():
    fps = clusters(1)
    label = S.linked(fps, np.zeros(len(fps), np.int64), np.arange(len(fps)), np.zeros(len(fps), np.int64))
    assert (label == brute_labels(fps)).all()


@pytest.mark.parametrize(("tree", "most"), [(S.TREE, S.MOST), (4, S.MOST), (4, 3)])
def test_shards_miss_no_link(spark, tree, most):
    # Fingerprints that share their first 32 bits, so that some shards hold most of them.
    fps = clusters(2) >> np.uint64(32)
    fps = np.unique(fps)
    joined = S.grouped(S.links(spark.createDataFrame([(int(f),) for f in fps], "fp long"), tree, most)).collect()
    root = {r.node: r.root for r in joined}
    got = [root.get(int(f), int(f)) for f in fps]
    want = brute_labels(fps)
    assert len(set(got)) == len(set(want.tolist()))
    assert len({*zip(got, want.tolist(), strict=True)}) == len(set(got))


def test_groups_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.root for r in S.grouped(edges).collect() if r.node != r.root} == {**dict.fromkeys(range(1, 61), 0), 101: 100}


def test_masks_cover_every_pair_within_the_radius():
    for blocks in (S.BLOCKS, 7, S.FINE):
        masks = [m & (1 << 64) - 1 for m in S.block_masks(blocks)]
        rng = np.random.default_rng(3)
        for _ in range(500):
            x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not x & m for m in masks)
    assert [S.blocks_for(n) for n in (0, 10**9, 10**11, 10**12)] == [6, 6, 7, 8]


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, `a.b` int")
    left = S.first_of_each(docs)
    assert left.columns == docs.columns
    # The copy without an id goes; what is in no group with an id stays.
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted({c for _, _, c in brute_groups(ROWS)}, key=repr)


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(300)) for c in "xyz")
    near = x.replace("x150", "other")
    # Three texts under one id; 1 has texts of two groups, and 2 one of a group whose first document is 0.
    rows = [(5, x), (5, y), (5, z), (6, near), (1, z), (1, z), (2, z), (2, "short"), (0, "short"), (None, "only here"), (None, "only here"), (None, "ONLY here"), (None, x), (None, near)]
    assert (brute_print(x) ^ brute_print(near)).bit_count() <= 4
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` int")
    left = S.first_of_each(docs).collect()
    assert sorted(((r.doc_id, r.text.lower()) for r in left), key=repr) == sorted([(5, x), (5, y), (1, z), (0, "short"), (None, "only here")], key=repr)
    assert sorted(map(tuple, left), key=repr) == sorted(map(tuple, S.first_of_each(docs.repartition(5)).collect()), key=repr)


def test_of_equal_rows_one_stays(spark):
    rows = [(1, "a b c", {"k": 1}, 7)] * 40 + [(None, None, None, None)] * 3 + [(2, "d e f", None, None)]
    left = S.first_of_each(spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, hash int")).collect()
    assert sorted(((r.doc_id, r.text, r.m, r.hash) for r in left), key=repr) == sorted([rows[0], rows[-2], rows[-1]], key=repr)


def test_hot_fingerprints_are_not_shuffled(spark, monkeypatch):
    rows = [(k, "same text here") for k in range(900)] + [(1000 + k, f"text number {k} of its own") for k in range(300)]
    monkeypatch.setattr(S, "HOT", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in S.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == brute_groups(rows)


def test_empty_table(spark):
    assert S.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0
