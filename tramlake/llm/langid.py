"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One logistic regression a bit, over hashed byte n-grams of the lower-cased text, tells
which half of the languages a text belongs to. Decoding takes the codeword with the least loss, where each bit's loss is
weighted by how well its classifier did on that language's training rows; a text is ambiguous if the hard decisions are
further from that codeword than the code can correct, or if the runner-up's loss is almost the same.

Training uses a bounded sample: about QUOTA doc_ids a language and TRAIN_ROWS in all, one at least of each language, chosen by a
hash of doc_id among the rows that are not held out. Their n-gram counts, of fixed size, go to one task; only the model reaches the
driver. More than LANGUAGES languages are refused.

Defined cases: null text, or text without a letter, is `und` with score 0; no labelled rows at all makes every text `und`; one
language alone is predicted for all; a null lang teaches nothing; of rows that share a lang and doc_id the least text teaches;
texts with equal letters get equal predictions.
"""

from __future__ import annotations

import pickle
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tramlake.llm.common import crc32_of_id, row_schema, text_blocks, texts_of, with_text

FOLDS, HELD_OUT = 4, 2
QUOTA, TRAIN_ROWS, LANGUAGES = 500, 4000, 1000
#: log2 of the hashed n-gram space, and n.
BITS, N = 12, 3
ROUNDS, RATE, DECAY = 300, 20.0, 1e-5
#: A runner-up whose mean weighted loss is within this of the best makes a text ambiguous.
MARGIN = 0.02
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Every ASCII byte that isn't a letter becomes a space.
TABLE = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of the lower-cased letters; n-grams of spaces alone are left out."""
    out = np.zeros(1 << BITS, np.int64)
    for piece in text_blocks(text.lower().encode("utf-8", "replace").translate(TABLE)):
        b = np.frombuffer(b" " + piece + b" ", np.uint8).astype(np.uint32)
        if len(b) < N:
            continue
        grams = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        grams = grams[grams != 0x202020]
        out += np.bincount(grams * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares: rows of length 1 (or 0)."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1: all different splits for up to 5 languages, else the random code of the largest least distance."""
    if n <= 5:
        splits = [s for s in product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, np.float64).reshape(-1, n).T.copy()
    rng, best, far = np.random.default_rng(11), None, -1
    width = max(15, int(np.ceil(10 * np.log2(n))))
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (n, width))
        apart = (width - code @ code.T) / 2
        least = (apart + width * np.eye(n)).min()
        if least > far and (np.abs(code.sum(axis=0)) < n).all():
            best, far = code, least
    return best


def losses(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins of the bits, and each language's weighted loss."""
    margin = x @ model["w"] + model["b"]
    each = np.logaddexp(0, -margin[:, None, :] * model["code"][None])
    return margin, (each * model["trust"][None]).sum(axis=2)


def fit(x: np.ndarray, lang: list[str]) -> dict:
    """A classifier a bit by gradient descent on all rows, languages weighing alike."""
    names = sorted(set(lang))
    own = np.array([names.index(v) for v in lang], np.int64)
    code = codewords(len(names))
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    model = {"names": names, "code": code, "w": w, "b": b, "trust": np.full(code.shape, 1 / max(1, code.shape[1]))}
    if code.shape[1]:
        want = (code[own] > 0).astype(np.float32)
        share = (1 / np.bincount(own)[own] / len(names)).astype(np.float32)[:, None]
        for _ in range(ROUNDS):
            off = (1 / (1 + np.exp(-(x @ w + b))) - want) * share
            w -= RATE * (x.T @ off + DECAY * w)
            b -= off.sum(axis=0)
        right = ((x @ w + b > 0) == (want > 0)).astype(np.float64)
        for k in range(len(names)):
            trust = right[own == k].mean(axis=0) + 1e-3
            model["trust"][k] = trust / trust.sum()
    return model


def decode(model: dict, x: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Nearest languages, scores (the share of exp(-loss) over all bits) and whether each is ambiguous."""
    code = model["code"]
    margin, loss = losses(model, x)
    best = loss.argmin(axis=1)
    mass = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * max(1, code.shape[1]))
    score = 1 / mass.sum(axis=1)
    if len(code) < 2:
        return [model["names"][k] for k in best], score, np.zeros(len(best), bool)
    apart = (code.shape[1] - code @ code.T) / 2
    radius = ((apart + 1e9 * np.eye(len(code))).min() - 1) // 2
    wrong = (np.where(margin > 0, 1, -1) != code[best]).sum(axis=1)
    two = np.partition(loss, 1, axis=1)
    return [model["names"][k] for k in best], score, (wrong > radius) | (two[:, 1] - two[:, 0] < MARGIN)


def train(docs: DataFrame) -> dict | None:
    """The model, or None if no row teaches a language."""
    rows = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc32_of_id("doc_id") % FOLDS != HELD_OUT))
    lots = F.crc32(F.concat(F.lit("lang:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")) % F.lit(1 << 31)
    rows = rows.withColumn("lot", lots)
    per = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("lot").alias("least")).limit(LANGUAGES + 1).collect()  # one row a language
    if not per:
        return None
    if len(per) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    quota = max(1, min(QUOTA, TRAIN_ROWS // len(per)))
    # A hash below quota / count of 2^31 takes about the quota of each language, wherever its rows are; the least hash is always taken.
    drawn = F.create_map(*(F.lit(v) for r in per for v in (r.lang, max(min(1.0, quota / r.n) * (1 << 31), float(r.least + 1)))))[F.col("lang")]

    def counted(batches):
        for batch in batches:
            lang, text = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for k in range(0, len(lang), 256):
                found = [ngram_counts(t) for t in text[k : k + 256]]
                yield pa.RecordBatch.from_arrays([pa.array(lang[k : k + 256]), pa.array([scaled(c[None])[0].astype(np.float16).tobytes() for c in found])], names=["lang", "x"])

    once = rows.where(F.col("lot") < drawn).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    sample = once.select("lang", "text").mapInArrow(counted, "lang string, x binary")

    def fitted(batches):
        lang, x = [], []
        for batch in batches:
            lang += batch.column("lang").to_pylist()
            x += [np.frombuffer(c, np.float16) for c in batch.column("x").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(np.stack(x).astype(np.float32), lang)) if lang else None], pa.binary())], names=["model"])

    # TRAIN_ROWS bounds the task: 32 MB of counts.
    models = sample.repartition(1).sortWithinPartitions("lang", "x").mapInArrow(fitted, "model binary").collect()
    return next((pickle.loads(r.model) for r in models if r.model), None)


def identify(docs: DataFrame, model: dict | None, keep: list[str] | None = None) -> DataFrame:
    """row (struct of the columns `keep`), lang_pred, score and ambiguous of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BITS bounds it: 16 kB a codeword bit

    def told(batches):
        for batch in batches:
            text, model = [t.decode("utf-8", "replace") for t in texts_of(batch)], shared.value
            lang, score, ambiguous = [UNKNOWN] * len(text), np.zeros(len(text)), np.ones(len(text), bool)
            clear = [k for k, t in enumerate(text) if model and t and LETTER.search(t)]
            for k in range(0, len(clear), 256):
                part = clear[k : k + 256]
                found, score[part], ambiguous[part] = decode(model, scaled(np.stack([ngram_counts(text[i]) for i in part])))
                for i, name in zip(part, found, strict=True):
                    lang[i] = name
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang), pa.array(score), pa.array(ambiguous)], names=["row", "lang_pred", "score", "ambiguous"])

    rows = with_text(docs, keep)
    return rows.mapInArrow(told, row_schema(rows, "lang_pred string, score double, ambiguous boolean"))


def known(docs: DataFrame) -> DataFrame:
    """The documents in an identified language, with all their columns; `und` and ambiguous ones go."""
    return identify(docs, train(docs)).where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    out = identify(docs, train(docs), ["doc_id"])
    return out.select("row.doc_id", (crc32_of_id("row.doc_id") % FOLDS == HELD_OUT).alias("held_out"), "lang_pred", "score", "ambiguous")
