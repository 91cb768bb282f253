"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes decides where pieces end: at block size 2^k, where its mixed value ends in k zero bits. A piece's
hash gives one character of the signature. A fingerprint holds the signatures for the least block size of which a text has up to
PIECES pieces, and for the next one; two fingerprints are comparable if one of their block sizes is the same, and
their likeness is one minus the edit distance of those signatures over the longer one's length.

The next document in the order of descending doc_id is found by one range shuffle of the texts; where a range ends, the first
row of the next range is joined to its last row, so no task sees more than its range. There are as many ranges as the table's bytes ask for.

Defined cases: null counts as empty text; an empty text has the fingerprint "4::", like itself alone; rows with equal doc_ids
follow each other by a hash of the text, then the text, and may lie in several ranges; a null doc_id comes last; a single document is its own next; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tramlake.llm.common import cut, partitions_for

SPAN = 7
PIECES, FEW = 64, 16
LEAST = 2
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


def triggers(chunk: np.ndarray, before: bytes) -> np.ndarray:
    """For each byte, how many zero bits the mixed hash of the SPAN bytes up to it ends in; before: the bytes in front."""
    b = np.concatenate((np.zeros(SPAN - 1 - len(before), np.uint8), np.frombuffer(before, np.uint8), chunk)).astype(np.uint32)
    n = len(chunk)
    h = np.zeros(n, np.uint32)
    for k in range(SPAN):
        h = h * np.uint32(0x01000193) + b[k : k + n] + np.uint32(1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return np.bitwise_count((h - np.uint32(1)) & ~h)


def powers(n: int, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    if len(kept.get("up", ())) < n:
        size = min(CHUNK, max(1 << 14, 2 * n))
        for name, base in (("up", BASE), ("down", BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept[name] = np.multiply.accumulate(steps)
    return kept["up"], kept["down"]


def chunks(text: bytes):
    """Pieces of a text of up to CHUNK bytes as arrays, with the SPAN - 1 bytes in front of each."""
    for at in range(0, len(text), CHUNK):
        yield np.frombuffer(text, np.uint8, min(CHUNK, len(text) - at), at), text[max(0, at - SPAN + 1) : at]


def fingerprint(text: bytes, kept: dict) -> str:
    counts, levels = np.zeros(34, np.int64), []
    for chunk, before in chunks(text):
        level = triggers(chunk, before)
        counts += np.bincount(level, minlength=34)
        levels = [level] if len(text) <= CHUNK else []
    ends = counts[::-1].cumsum()[::-1]  # ends[k]: pieces that end at block size 2^k
    k = LEAST + int((ends[LEAST:] < PIECES).argmax())
    if ends[k] < FEW and k > LEAST:
        k -= 1  # the pieces from the last character's on count as one
    out = []
    for block in (k, k + 1):
        pieces, open_hash, open_length = [], 0, 0
        for number, (chunk, before) in enumerate(chunks(text)):
            if len(pieces) >= PIECES - 1 and number:
                stops = np.empty(0, np.int64)
            else:
                stops = np.flatnonzero((levels[0] if levels else triggers(chunk, before)) >= block)[: PIECES - 1 - len(pieces)] + 1
            starts = np.concatenate(([0], stops[stops < len(chunk)]))
            up, down = powers(len(chunk), kept)
            sums = np.add.reduceat(chunk * up[: len(chunk)], starts) * down[starts]
            sums = sums.tolist()
            lengths = np.diff(np.concatenate((starts, [len(chunk)]))).tolist()
            for i, (s, n) in enumerate(zip(sums, lengths, strict=True)):
                open_hash = (open_hash + s * pow(BASE, open_length, 1 << 64)) & MASK
                open_length += n
                if i < len(stops):
                    pieces.append((open_hash, open_length))
                    open_hash, open_length = 0, 0
        if open_length:
            pieces.append((open_hash, open_length))
        out.append("".join(ALPHABET[((h ^ n) * 0xC2B2AE3D27D4EB4F & MASK) >> 58] for h, n in pieces))
    return f"{1 << k}:{out[0]}:{out[1]}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: how alike two fingerprints are."""
    a, b, both = F.split(a, ":"), F.split(b, ":"), a == b
    alike = lambda x, y: F.when((x == "") | (y == ""), 0.0).otherwise(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)))
    m, n = a[0].cast("long"), b[0].cast("long")
    return F.when(both, 1.0).when(m == n, alike(a[1], b[1])).when(m == 2 * n, alike(a[1], b[2])).when(n == 2 * m, alike(a[2], b[1])).otherwise(0.0)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many, or all, of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]

    def row(doc_id, text: str, own: str, following: str, next_own: str, kept: dict) -> tuple:
        new = edited(text, following).encode()
        return doc_id, len(text), sha256(new).hexdigest(), own, fingerprint(new, kept), next_own

    def walked(batches):
        """Rows of one range in order: results of all rows but the last, and the first and last rows themselves (edge 0, 1)."""
        kept, place, last, fields = {}, TaskContext.get().partitionId(), None, None
        for batch in batches:
            fields = batch.schema
            out, edges = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = fingerprint(text.encode(), kept)
                if last is None:
                    edges.append((doc_id, text, own, 0))
                else:
                    out.append(row(*last, text, own, kept))
                last = (doc_id, text, own)
            yield assembled(fields, out, edges, place)
        if last is not None:
            yield assembled(fields, [], [(*last, 1)], place)

    def assembled(fields, out, edges, place):
        ids = pa.array([x[0] for x in (*out, *edges)], fields.field("doc_id").type)
        cells = [pa.array([x[k] for x in out] + [None] * len(edges), t) for k, t in ((1, pa.int64()), (2, pa.string()))]
        cells.append(pa.array([x[3] for x in out] + [x[2] for x in edges], pa.string()))
        cells += [pa.array([x[k] for x in out] + [None] * len(edges), pa.string()) for k in (4, 5)]
        cells.append(pa.array([None] * len(out) + [x[1] for x in edges], pa.string()))
        cells.append(pa.array([None] * len(out) + [x[3] for x in edges], pa.int32()))
        cells.append(pa.array([place] * (len(out) + len(edges)), pa.int32()))
        return pa.RecordBatch.from_arrays([ids, *cells], names=[*names, "text", "edge", "place"])

    def closed(batches):
        """Results of the ranges' last rows."""
        kept = {}
        for batch in batches:
            got = [row(*x, kept) for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[1] for x in got], pa.int64()), *(pa.array([x[k] for x in got], pa.string()) for k in range(2, 6))], names=names)

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.repartitionByRange(partitions_for(texts), *order[:2]).sortWithinPartitions(*order)
    done = cut(texts.mapInArrow(walked, f"{result}, text string, edge int, place int"))
    firsts = done.where("edge = 0").select("place", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    # One short row a range: the range that follows it, the first again after the last.
    follow = firsts.select("place").withColumn("follows", F.coalesce(F.lead("place").over(W.orderBy("place")), F.min("place").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    lasts = done.where("edge = 1").select("doc_id", "text", "fingerprint", "place").join(follow, "place").drop("place")
    ends = lasts.join(firsts.withColumnRenamed("place", "follows"), "follows").drop("follows").mapInArrow(closed, result)
    return done.where("edge is null").select(*names).union(ends)


def query(docs: DataFrame) -> DataFrame:
    out = fingerprinted(docs)
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
