from hashlib import sha256

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tramlake.llm import ctph as C


def slow_fingerprint(text: bytes) -> str:
    """Byte by byte."""
    window, levels = [0] * C.SPAN, []
    for b in text:
        window = [*window[1:], b]
        h = 0
        for x in window:
            h = (h * 0x01000193 + x + 1) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 13
        levels.append(32 if not h else (h & -h).bit_length() - 1)
    k = C.LEAST
    while sum(v >= k for v in levels) >= C.PIECES:
        k += 1
    if sum(v >= k for v in levels) < C.FEW and k > C.LEAST:
        k -= 1
    out = []
    for block in (k, k + 1):
        pieces, now = [], []
        for b, v in zip(text, levels, strict=True):
            now.append(b)
            if v >= block and len(pieces) < C.PIECES - 1:
                pieces.append(now)
                now = []
        pieces += [now] if now else []
        hashes = [(sum(b * pow(C.BASE, i, 1 << 64) for i, b in enumerate(p)) & C.MASK, len(p)) for p in pieces]
        out.append("".join(C.ALPHABET[((h ^ n) * 0xC2B2AE3D27D4EB4F & C.MASK) >> 58] for h, n in hashes))
    return f"{1 << k}:{out[0]}:{out[1]}"


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.binary(max_size=700), st.text(alphabet="ab ", max_size=900).map(str.encode), st.integers(0, 400).map(lambda n: b"und " * n)))
def test_fingerprint_byte_by_byte(text):
    assert C.fingerprint(text, {}) == slow_fingerprint(text)


def test_chunks_of_a_long_text(monkeypatch):
    text = np.random.default_rng(4).integers(97, 123, 30_000, dtype=np.uint8).tobytes()
    whole = C.fingerprint(text, {})
    monkeypatch.setattr(C, "CHUNK", 700)
    assert C.fingerprint(text, {}) == whole


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def slow_likeness(a, b):
    if a == b:
        return 1.0
    (m, *p), (n, *q) = a.split(":"), b.split(":")
    x, y = {(True, False): (p[0], q[1]), (False, True): (p[1], q[0])}.get((int(m) == 2 * int(n), int(n) == 2 * int(m)), (p[0], q[0]) if m == n else ("", ""))
    return 1 - distance(x, y) / max(len(x), len(y)) if x and y else 0.0


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sorted((tuple(r) for r in C.query(docs).collect()), key=repr)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).astype(np.int64), r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        third = len(t) // 3
        new = t[: len(t) - third] + following[:third]
        own, other, next_ = (C.fingerprint(x.encode(), {}) for x in (t, new, following))
        want.append((i, len(t), sha256(new.encode()).hexdigest(), own, other, slow_likeness(own, other), slow_likeness(own, next_)))
    assert got == sorted(want, key=repr)
    return got


def test_edges_of_ranges_and_odd_rows(spark):
    rows = [(k * 7 % 101, f"text {k} " * (k % 13 * 9 + 1)) for k in range(101)]
    check(spark, [*rows, (500, None), (501, ""), (502, "é€😀" * 20), (502, "é€😀" * 20), (None, "last"), (None, "first"), (-5, "x"), *((77, f"shared id {k} " * 9) for k in range(30))])


def test_few_rows(spark):
    check(spark, [(1, "alone and only")])
    check(spark, [(1, "one text here"), (2, "another text there")])
    assert C.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tables(spark, sf):
    got = check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    assert np.mean([r[5] for r in got]) > 0.55 > 0.2 > np.mean([r[6] for r in got])


def test_likeness_of_neighbouring_block_sizes(spark):
    cases = [("8:abcd:xy", "16:xz:q"), ("16:xz:q", "8:abcd:xy"), ("8:abcd:xy", "32:a:b"), ("4::", "4:a:b"), ("4::", "4::"), ("8:abcd:xy", "8:abxd:xy")]
    df = spark.createDataFrame(cases, "a string, b string")
    assert [r.x for r in df.select(C.likeness(F.col("a"), F.col("b")).alias("x")).collect()] == [slow_likeness(a, b) for a, b in cases]
