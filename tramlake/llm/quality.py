"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader (proximal) updates.

Tokens are runs of letters and digits and runs of other visible bytes, case kept. Features are hashed tokens and token pairs; a
token followed by itself is one feature whatever the token. A document's vector holds the logarithms of its counts, scaled to
one length, and its score is the logistic function of that sparse vector's dot product with the weights.

Training uses a bounded sample: about TRAIN_ROWS labelled doc_ids, chosen by their hash among those that are not held out, each with one
label and one document. One task streams them in a fixed order through the updates; only the weights leave it.

Defined cases: null and empty texts are scored by the bias alone; without any labelled row every score is 0.5; null labels and null
doc_ids teach nothing; a doc_id with several labels has their mean, one with several documents is seen with the one whose vector comes
first; repeated texts get equal scores.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tramlake.llm.common import as_bytes, crc32_of_id, row_schema, text_blocks, texts_of, with_text

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
TRAIN_ROWS, PASSES = 12_000, 2
#: log2 of the hashed feature space; length of a document's vector.
BITS, LENGTH = 18, 10.0
#: Learning rate, its smoothing, and the penalties of the updates.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 0.1
#: Tokens whose hashes are kept between documents.
KEPT = 200_000
TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
TABLE = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))


def token_hashes(tokens: list[bytes], kept: dict[bytes, int]) -> np.ndarray:
    if len(kept) > KEPT:
        kept.clear()
    for t in set(tokens).difference(kept):
        kept[t] = zlib.crc32(t)
    return np.fromiter(map(kept.__getitem__, tokens), np.uint64, len(tokens))


def vector(text: bytes, kept: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text."""
    found, before = [], np.empty(0, np.uint64)
    for piece in text_blocks(text.translate(TABLE)):
        one = np.concatenate((before, token_hashes(TOKENS.findall(piece), kept)))
        pair = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS)
        pair[one[:-1] == one[1:]] = 0
        found.append(np.unique(np.concatenate((one[len(before) :] & np.uint64((1 << BITS) - 1), pair)), return_counts=True))
        before = one[-1:]
    at, n = found[0]
    if len(found) > 1:
        at, back = np.unique(np.concatenate([a for a, _ in found]), return_inverse=True)
        n = np.bincount(back, np.concatenate([k for _, k in found]))
    x = np.log1p(n)
    return at.astype(np.int64), x * (LENGTH / np.sqrt(max((x * x).sum(), 1e-12)))


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that minimise the linearised losses so far and the penalties."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(rows) -> np.ndarray:
    """Weights, the bias last, from (vector, label) pairs in order."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for (at, x), label in rows:
        at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
        zi, ni = z[at], n[at]
        w = leader(zi, ni)
        g = (1 / (1 + np.exp(-(w @ x))) - label) * x
        more = ni + g * g
        z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
        n[at] = more
    return leader(z, n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights, or None if no labelled row is there to learn from."""
    taught = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label IS NOT NULL AND doc_id IS NOT NULL").where(crc32_of_id("doc_id") % FOLDS != HELD_OUT)
    taught = taught.groupBy("doc_id").agg(F.avg("label").alias("label"))
    n = taught.count()
    if not n:
        return None
    lot = F.crc32(F.concat(F.lit("quality:"), F.col("doc_id").cast("string")).cast("binary"))
    drawn = taught.withColumn("lot", lot).where(F.col("lot") < min(1.0, TRAIN_ROWS / n) * 2**32)
    # About TRAIN_ROWS short rows: a proven bound for the broadcast.
    sample = docs.select("doc_id", as_bytes("text").alias("text")).join(F.broadcast(drawn), "doc_id").select("lot", "doc_id", "label", "text")

    def vectors(batches):
        kept: dict[bytes, int] = {}
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [vector(t, kept) for t in part.column("text").to_pylist()]
                cells = [pa.array([a.astype(np.int32).tobytes() for a, _ in found]), pa.array([x.astype(np.float32).tobytes() for _, x in found])]
                yield pa.RecordBatch.from_arrays([part.column("lot"), part.column("doc_id"), part.column("label"), *cells], names=["lot", "doc_id", "label", "at", "x"])

    def fitted(batches):
        rows = (
            ((np.frombuffer(a, np.int32), np.frombuffer(x, np.float32)), y)
            for batch in batches
            for a, x, y in zip(batch.column("at"), batch.column("x"), batch.column("label").to_pylist(), strict=True)
            for a, x in [(a.as_py(), x.as_py())]
        )
        first = next(rows, None)
        yield pa.RecordBatch.from_arrays([pa.array([fit(chain([first], rows)).tobytes() if first else None], pa.binary())], names=["w"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = sample.mapInArrow(vectors, f"lot bigint, doc_id {kind}, label double, at binary, x binary")
    # One document a doc_id, found before the shuffle too, so that a labelled id that very many rows share stays one row.
    found = found.groupBy("lot", "doc_id", "label").agg(F.min(F.struct("at", "x")).alias("v")).select("lot", "doc_id", "label", "v.at", "v.x")
    # Each pass is a copy of the sample, so that the task holds the weights and a batch, however long the texts are.
    passes = found.withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES)))))
    weights = passes.repartition(1).sortWithinPartitions("pass", "lot", "doc_id", "at", "label").mapInArrow(fitted, "w binary").collect()
    return next((np.frombuffer(r.w, np.float32) for r in weights if r.w), None)


def scored(docs: DataFrame, weights: np.ndarray | None, keep: list[str] | None = None) -> DataFrame:
    """row (struct of the columns `keep`) and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # BITS bounds it: 1 MB

    def told(batches):
        kept: dict[bytes, int] = {}
        for batch in batches:
            w, out = shared.value, []
            for text in texts_of(batch):
                if w is None:
                    out.append(0.5)
                    continue
                at, x = vector(text, kept)
                out.append(float(1 / (1 + np.exp(-(w[at] @ x + w[-1])))))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.float64())], names=["row", "score"])

    rows = with_text(docs, keep)
    return rows.mapInArrow(told, row_schema(rows, "score double"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score THRESHOLD or more, with all their columns."""
    return scored(docs, train(docs, labels)).where(F.col("score") >= THRESHOLD).select("row.*")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs, train(docs, labels), ["doc_id"])
    return out.select("row.doc_id", (crc32_of_id("row.doc_id") % FOLDS == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
