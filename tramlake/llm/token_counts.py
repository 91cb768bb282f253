"""Token counts of whole texts without materialising token ids.

The library makes tokens of a text in two steps: normalizer and splitting pattern make pre-tokens, and its model cuts each
pre-token into pieces by itself. So a text's count is the sum over its distinct pre-tokens of frequency times pieces:

1. One map cuts the documents into blocks of up to BLOCK_TEXT bytes. A block has a list of its distinct pre-tokens; each of its documents
   has the frequencies of its pre-tokens by their place in that list, some two bytes for each. Pre-tokens never cross white space, so
   texts are split there by Arrow and the library splits only the runs that are new to a task. Lists and frequencies are written once.
2. The lists are dealt by a hash of the pre-token: a row is a block's part of a bucket. There, each distinct pre-token of the corpus goes
   through the library's model once, and its pieces are joined to all blocks that have it. More text makes more buckets.
3. The pieces go back to their block, whose documents meet them in a task that sums over the frequencies, document by document.

Nothing is shuffled that has a row a document and pre-token, and no token id is made.

Defined cases: null counts as empty text (0 bytes, 0 tokens); a text without white space is one run; a text longer than a block is a block of
its own; the library's special strings are one pre-token together with the run that they are in; repeated rows are counted alike; columns
other than the id and the text are ignored; a tokenizer whose pre-tokens cross white space, or whose pieces depend on it, is refused.
"""

from __future__ import annotations

import json
import os
import zlib
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tramlake.llm.common import as_bytes, partitions_for, shared_dir

LIMIT = 2048
#: The tokenizer file goes to the executors whole; one that is larger than this is refused.
FILE_BYTES = 64 << 20
#: Bytes of text in a block; runs whose pre-tokens a task keeps, and the longest run that it keeps.
BLOCK_TEXT, KEPT, KEPT_BYTES = 8 << 20, 300_000, 48
#: Runs that are split by the library at once.
AT_ONCE = 20_000
#: What is in front of a run that holds a special string, in the place of a pre-token.
WHOLE = "\x00"
#: Texts that a tokenizer must count as the sum over what lies between white space.
PROBES = ("a b", " a", "a ", "word  word\tA \n B", "don't x12 é́ 日本 語", "( a ) ...\r\n\x0b\x0cq", "the quick Brown fox, 3.14 <x> it's", " a 　 b")


def loaded(data: bytes):
    """The tokenizer of a file's bytes, without truncation and padding, and its special strings."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t["content"] for t in json.loads(data).get("added_tokens") or []]


def pre_tokens(tokenizer, special: list[str], run: str) -> list[str]:
    """The pre-tokens of a text without white space, as the library's model gets them."""
    if any(s in run for s in special):
        return [WHOLE + run]
    if tokenizer.normalizer:
        run = tokenizer.normalizer.normalize_str(run)
    if not tokenizer.pre_tokenizer:
        return [run] if run else []
    return [t for t, _ in tokenizer.pre_tokenizer.pre_tokenize_str(run)]


def pieces(tokenizer, token: str) -> int:
    """The number of a pre-token's pieces."""
    if token.startswith(WHOLE):
        return len(tokenizer.encode(token.removeprefix(WHOLE), add_special_tokens=False))
    return len(tokenizer.model.tokenize(token))


def check(tokenizer, special: list[str]) -> None:
    for text in PROBES:
        parts = sum(pieces(tokenizer, t) for run in text.encode().split() for t in pre_tokens(tokenizer, special, run.decode()))
        if parts != len(tokenizer.encode(text, add_special_tokens=False)):
            raise ValueError("the tokenizer's pieces depend on white space: texts can't be counted by pre-tokens")


class Splitter:
    """Pre-tokens of runs, kept for the runs that came before."""

    def __init__(self, tokenizer, special: list[str]):
        self.tokenizer, self.special, self.kept = tokenizer, special, {}

    def together(self, runs: list[str]) -> list[list[str]]:
        """The pre-tokens of several runs by one call; runs with special strings or white space of other kinds are split one by one."""
        plain = [r for r in runs if len(r.split()) == 1 and not any(x in r for x in self.special)]
        joined = " ".join(plain)
        joined = self.tokenizer.normalizer.normalize_str(joined) if self.tokenizer.normalizer else joined
        parts = joined.split(" ")
        if not self.tokenizer.pre_tokenizer or len(parts) != len(plain):
            return [pre_tokens(self.tokenizer, self.special, r) for r in runs]
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(joined)
        ends = np.cumsum([len(p) + 1 for p in parts])
        stops = np.searchsorted([at for _, (at, _) in found], ends).tolist()
        tokens = [t for t, _ in found]
        own = dict(zip(plain, (tokens[a:b] for a, b in zip([0, *stops], stops, strict=False)), strict=True))
        return [own[r] if r in own else pre_tokens(self.tokenizer, self.special, r) for r in runs]

    def __call__(self, runs: list[str]) -> list[list[str]]:
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = [r for r in runs if r not in self.kept]
        found = {}
        for k in range(0, len(new), AT_ONCE):
            part = new[k : k + AT_ONCE]
            found.update(zip(part, self.together(part), strict=True))
        out = [found[r] if r in found else self.kept[r] for r in runs]
        self.kept.update((r, t) for r, t in found.items() if len(r) <= KEPT_BYTES)
        return out


def block(texts: pa.Array, split: Splitter) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of texts; of all texts one after the other the places (rising) and frequencies of their pre-tokens, and where each text's begin."""
    words = pc.ascii_split_whitespace(texts)
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(words.flatten())
    runs = coded.dictionary.to_pylist()
    tokens: dict[str, int] = {}
    found = [[tokens.setdefault(t, len(tokens)) for t in own] for own in split(runs)]
    width = np.array([len(f) for f in found], np.int64)
    first = np.cumsum(width) - width
    flat = np.fromiter((k for f in found for k in f), np.int64, int(width.sum()))
    # Runs of a text are counted before they are replaced by their pre-tokens, which are then counted again.
    many = max(1, len(runs))
    key, n = np.unique(np.repeat(np.arange(len(texts)) * many, sizes) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    text, run = key // many, key % many
    own = np.repeat(np.arange(len(run)), width[run])
    at = np.arange(len(own)) - np.repeat(np.cumsum(width[run]) - width[run] - first[run], width[run])
    many = max(1, len(tokens))
    key, back = np.unique(text[own] * many + flat[at], return_inverse=True)
    n = np.bincount(back, n[own], len(key)).astype(np.int64)
    return [*tokens], key % many, n, np.searchsorted(key // many, np.arange(len(texts) + 1))


def packed(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Numbers of 0 or more, seven bits a byte with the last byte of each below 128, as one binary value a range of `begin`."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 9):
        size += values >> 7 * k > 0
    stop = np.cumsum(size)
    out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        here = size > k
        out[stop[here] - size[here] + k] = (values[here] >> 7 * k & 127) | np.where(size[here] > k + 1, 128, 0)
    edges = np.concatenate(([0], stop))[begin]
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(out)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all packed() values one after the other, and where each value's begin."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    last = data < 128
    stop = np.flatnonzero(last) + 1
    start = np.concatenate(([0], stop))[:-1]
    shift = (np.arange(len(data)) - np.repeat(start, stop - start)) * 7
    values = np.add.reduceat((data & 127).astype(np.int64) << shift, start) if len(data) else np.empty(0, np.int64)
    sizes = np.array([len(x) for x in column.to_pylist()], np.int64)
    return values, np.concatenate(([0], np.cumsum(last)))[np.concatenate(([0], np.cumsum(sizes)))]


def frequencies(place: np.ndarray, n: np.ndarray, begin: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Packed: of each text the steps from place to place, twice, and one more where the frequency is not 1; and those frequencies."""
    step = np.diff(place, prepend=0)
    head = begin[:-1][begin[:-1] < begin[1:]]
    step[head] = place[head]
    often = n > 1
    return packed(step * 2 + often, begin), packed(n[often], np.concatenate(([0], np.cumsum(often)))[begin])


def totals(entries: pa.Array, more: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Of each text the sum of frequency times pieces; sizes: the pieces of the block's pre-tokens by place."""
    step, begin = unpacked(entries)
    place = np.cumsum(step >> 1)
    place -= np.repeat(np.concatenate(([0], place))[begin[:-1]], np.diff(begin))
    n = np.ones(len(step), np.int64)
    n[step & 1 > 0] = unpacked(more)[0]
    total = np.concatenate(([0], np.cumsum(sizes[place] * n)))
    return total[begin[1:]] - total[begin[:-1]]


def cuts(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of consecutive texts of up to `limit` bytes together; a longer text is alone."""
    out, at = [], 0
    while at < len(sizes):
        stop, total = at + 1, int(sizes[at])
        while stop < len(sizes) and total + sizes[stop] <= limit:
            total += int(sizes[stop])
            stop += 1
        out.append((at, stop))
        at = stop
    return out


def dealt(tokens: list[str], buckets: int):
    """Of a block's list for each bucket: its number, the pre-tokens, a line each, and their places, packed."""
    own = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) % buckets for t in tokens), np.int64, len(tokens))
    order = np.argsort(own, kind="stable")
    begin = np.concatenate((np.flatnonzero(np.diff(own[order], prepend=-1)), [len(order)]))
    step = np.diff(order, prepend=0)
    step[begin[:-1]] = order[begin[:-1]]
    listed = np.array(tokens, object)[order].tolist()
    texts = ["\n".join(listed[a:b]) for a, b in zip(begin, begin[1:], strict=False)]
    if sum(t.count("\n") + 1 for t in texts) != len(tokens):
        raise ValueError("a pre-token has a line break")
    return own[order][begin[:-1]], texts, packed(step, begin)


def blocks(docs: DataFrame, shared, block_text: int, buckets: int) -> DataFrame:
    """Rows of two kinds: a block's list, bucket by bucket (block, bucket, tokens, places), and its documents (block, doc_id, n_bytes, entries and more as
    frequencies() has them)."""
    kind = docs.schema["doc_id"].dataType

    def cut_up(batches):
        split, place, number = Splitter(*loaded(shared.value)), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            try:
                texts = texts.cast(pa.string())
            except pa.ArrowInvalid:  # bytes that are no UTF-8
                texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
            for a, b in cuts(sizes, block_text):
                tokens, at, n, begin = block(texts.slice(a, b - a), split)
                entries, more = frequencies(at, n, begin)
                ids = batch.column("doc_id").slice(a, b - a)
                yield rows(place << 32 | number, b - a, doc_id=ids, n_bytes=pa.array(sizes[a:b], pa.int64()), entries=entries, more=more)
                if tokens:
                    bucket, listed, places = dealt(tokens, buckets)
                    yield rows(place << 32 | number, len(bucket), doc_id=pa.nulls(len(bucket), ids.type), bucket=pa.array(bucket), tokens=pa.array(listed, pa.string()), places=places)
                number += 1

    def rows(number: int, n: int, **cells):
        return pa.RecordBatch.from_arrays([cells.get(name, pa.array([number] * n) if name == "block" else pa.nulls(n, t)) for name, t in kinds.items()], names=[*kinds])

    kinds = {"block": pa.int64(), "bucket": pa.int64(), "tokens": pa.string(), "places": pa.binary(), "doc_id": None, "n_bytes": pa.int64(), "entries": pa.binary(), "more": pa.binary()}
    schema = T.StructType.fromDDL("block bigint, bucket bigint, tokens string, places binary, doc_id int, n_bytes bigint, entries binary, more binary")
    schema["doc_id"].dataType = kind
    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(cut_up, schema)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, block_text: int = BLOCK_TEXT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs; path: a file of the `tokenizers` library."""
    spark = docs.sparkSession
    if (size := os.path.getsize(path)) > FILE_BYTES:
        raise ValueError(f"{path} has {size} bytes; the limit is {FILE_BYTES}")
    with open(path, "rb") as file:
        data = file.read()
    check(*loaded(data))
    shared = spark.sparkContext.broadcast(data)

    def joined(batches):
        """Parts of lists, sorted by bucket, to the pieces of each part's pre-tokens, by place."""
        (tokenizer, _), now, known = loaded(shared.value), None, {}
        for batch in batches:
            parts = []
            for bucket, tokens in zip(batch.column("bucket").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if bucket != now:
                    now, known = bucket, {}
                tokens = tokens.split("\n")
                known.update((t, pieces(tokenizer, t)) for t in tokens if t not in known)
                parts.append([known[t] for t in tokens])
            found = packed(np.array([n for p in parts for n in p], np.int64), np.cumsum([0, *map(len, parts)]))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("places"), found], names=["block", "places", "pieces"])

    def summed(batches):
        """Rows sorted by block, its pieces first, to the counts of its documents."""
        now, sizes = None, np.empty(0, np.int64)
        for batch in batches:
            block, found = batch.column("block").to_numpy(), batch.column("pieces").is_valid().to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (found[1:] != found[:-1])) + 1).tolist(), len(block)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if block[a] != now:
                    now, sizes = block[a], np.empty(0, np.int64)
                part = batch.slice(a, b - a)
                if found[a]:
                    step, begin = unpacked(part.column("places"))
                    place = np.cumsum(step)
                    place -= np.repeat(np.concatenate(([0], place))[begin[:-1]], np.diff(begin))
                    more = int(place.max(initial=-1)) + 1 - len(sizes)
                    sizes = np.concatenate((sizes, np.zeros(max(0, more), np.int64)))
                    sizes[place] = unpacked(part.column("pieces"))[0]
                else:
                    n = totals(part.column("entries"), part.column("more"), sizes)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    # A table and not a checkpoint, which would take several times the room.
    folder = f"{shared_dir(spark)}/tokens-{uuid4().hex}"
    held = blocks(docs, shared, block_text, partitions_for(docs))
    held.write.parquet(folder)
    held = spark.read.schema(held.schema).parquet(folder)
    lists = held.where("tokens IS NOT NULL").select("block", "bucket", "tokens", "places")
    found = lists.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(joined, "block bigint, places binary, pieces binary")
    rows = held.where("n_bytes IS NOT NULL").select("block", "doc_id", "n_bytes", "entries", "more").unionByName(found, allowMissingColumns=True)
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("pieces").isNull())
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("n_bytes bigint, n_tokens bigint").fields])
    return rows.mapInArrow(summed, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
