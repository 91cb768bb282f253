"""Benchmark decontamination over suffix arrays of the training documents.

Each task cuts its documents into shards of bounded size and sorts the suffixes of every shard's words. All suffixes of the
benchmark items that are long enough to hold a window are then binary-searched in the shard, one word deeper at each step, all
of them at once: the interval that is left after a window's length holds the window's occurrences, the last interval that is
not empty holds the longest verbatim matches. The shard's array leaves out suffixes that start in a run of benchmark words
too short for any window; no search could end there.

The benchmark is the stated query set. It is indexed and broadcast in blocks of at most BLOCK_TEXT bytes, one after the other, so the
driver holds one index. The documents pass through one map, which holds up to GROUP_TEXT bytes of them, at least a batch, and one
block's index at a time: nothing is shuffled, and a larger benchmark costs more time, not more memory.

Defined cases: null, empty and separator-only texts have no words and are never contaminated; items without words hit nothing;
repeated items count once by item_id (a null item_id is the empty string); every repeated document row is judged by itself.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pyspark.sql.pandas.types import to_arrow_type

from tramlake.llm.common import row_schema, spacing, texts_of, with_text, word_blocks

WINDOW = 13
#: A document is contaminated if it has a hit word and at least one word in so many is hit.
ONE_IN = 20
#: Bytes of benchmark text in a block, and of document text in a shard.
BLOCK_TEXT, SHARD_TEXT = 8 << 20, 8 << 20
#: Bytes of document text that a task holds for all blocks, where there are several.
GROUP_TEXT = 64 << 20

#: Separators of the contract's words: all of ASCII but digits and letters.
TABLE = spacing(b for b in range(128) if not chr(b).isalnum())

SPANS = "array<struct<start:bigint,stop:bigint>>"
LONGEST = "struct<words:bigint,item:string,at:bigint>"


def index_queries(items: list[tuple[str, bytes]]) -> SimpleNamespace:
    """A block of the benchmark: its words as ids, its suffixes that hold a window, and the items of each distinct window."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({name for name, _ in items})
    number = {name: k for k, name in enumerate(names)}
    words, starts, ends, depth, window, owner = [], [], [], [], [], []
    seen: dict[tuple, int] = {}
    pairs = set()
    for name, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for block in word_blocks(text.translate(TABLE)) for w in block]
        w, base = min(WINDOW, len(ids)), len(words)
        for k in range(len(ids) - w + 1 if ids else 0):
            own = seen.setdefault(tuple(ids[k : k + w]), len(seen))
            starts.append(base + k)
            ends.append(base + len(ids))
            depth.append(w)
            window.append(own)
            owner.append(number[name])
            pairs.add((own, number[name]))
        words += ids
    start, end, deep, window, owner = (np.array(x, np.int64) for x in (starts, ends, depth, window, owner))
    listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return SimpleNamespace(
        vocabulary=vocabulary, items=names, words=np.array([*words, 0], np.int32), start=start, end=end, depth=deep, window=window, owner=owner,
        windows=len(seen), window_items=listed[:, 1], window_at=np.searchsorted(listed[:, 0], np.arange(len(seen) + 1)),
        shortest=min(depth, default=0), longest=int((end - start).max()) if starts else 0,
    )


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero words by the words that follow, as far as `depth` words tell, by prefix doubling."""
    n = len(words)
    rank, step = words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + later
        order = np.argsort(key, kind="stable")
        rise = np.concatenate(([0], np.diff(key[order]) != 0)).cumsum()
        zero = words[order[0]] == 0
        rank = np.empty(n, np.int64)
        rank[order] = rise + (0 if zero else 1)
        if rise[-1] == n - 1:
            break
        step *= 2
    return order[words[order] > 0]


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [lo, hi) one after the other, and the number of the range of each."""
    n = hi - lo
    own = np.repeat(np.arange(len(lo)), n)
    return np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n), own


def search(q: SimpleNamespace, words: np.ndarray, sa: np.ndarray):
    """Intervals of `sa` at each suffix's window depth, and at the deepest match; words must end with q.longest zeros."""
    n = len(q.start)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(sa), np.int64)
    win_lo, win_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best, best_lo, best_hi = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)
    for k in range(q.longest):
        live = live[q.start[live] + k < q.end[live]]
        if not len(live):
            break
        want = q.words[q.start[live] + k]
        bounds = []
        for right in (False, True):
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                got = words[sa[np.where(open_, mid, 0)] + k]
                less = open_ & ((got <= want) if right else (got < want))
                a = np.where(less, mid + 1, a)
                b = np.where(open_ & ~less, mid, b)
            bounds.append(a)
        lo[live], hi[live] = bounds
        live = live[bounds[0] < bounds[1]]
        best[live], best_lo[live], best_hi[live] = k + 1, lo[live], hi[live]
        full = live[q.depth[live] == k + 1]
        win_lo[full], win_hi[full] = lo[full], hi[full]
    return win_lo, win_hi, best, best_lo, best_hi


def scan(q: SimpleNamespace, texts: list[bytes]):
    """For each text of a shard: number of words, hit spans, items, longest match."""
    get, parts, counts = q.vocabulary.get, [], []
    for text in texts:
        n = 0
        for block in word_blocks(text.translate(TABLE)):
            parts.append(np.fromiter((get(w, 0) for w in block), np.int32, len(block)))
            n += len(block)
        parts.append(np.zeros(1, np.int32))
        counts.append(n)
    out = [(n, [], [], None) for n in counts]
    if not q.windows:
        return out
    ids = np.concatenate(parts)
    first = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))[:-1]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
    begin, stop = edge[::2], edge[1::2]
    far = stop - begin >= q.shortest
    at, _ = ranges(begin[far], stop[far] + 1)  # with the zero that follows each run
    if not len(at):
        return out
    words = np.concatenate((ids[at], np.zeros(q.longest + 1, np.int32)))
    sa = suffix_array(words[: len(at)], q.longest)
    win_lo, win_hi, best, best_lo, best_hi = search(q, words, sa)

    found = np.flatnonzero(win_hi > win_lo)
    if not len(found):
        return out
    _, one = np.unique(q.window[found], return_index=True)
    one = found[one]  # a window's occurrences are marked once, however many items share it
    place, own = ranges(win_lo[one], win_hi[one])
    spot, wide, window = at[sa[place]], q.depth[one][own], q.window[one][own]
    change = np.bincount(spot, minlength=len(ids) + 1) - np.bincount(spot + wide, minlength=len(ids) + 1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(change) > 0).view(np.int8), [0]))))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        d = int(np.searchsorted(first, a, "right")) - 1
        out[d][1].append({"start": a - int(first[d]), "stop": b - int(first[d])})

    doc = np.searchsorted(first, spot, "right") - 1
    pairs = np.unique(doc * q.windows + window)
    doc, window = pairs // q.windows, pairs % q.windows
    listed, own = ranges(q.window_at[window], q.window_at[window + 1])
    pairs = np.unique(doc[own] * len(q.items) + q.window_items[listed])
    for d, k in zip((pairs // len(q.items)).tolist(), (pairs % len(q.items)).tolist(), strict=True):
        out[d][2].append(q.items[k])

    far = np.flatnonzero(best >= q.depth)
    place, own = ranges(best_lo[far], best_hi[far])
    spot, length, owner = at[sa[place]], best[far][own], q.owner[far][own]
    doc = np.searchsorted(first, spot, "right") - 1
    order = np.lexsort((spot, owner, -length, doc))
    _, top = np.unique(doc[order], return_index=True)
    for k in order[top].tolist():
        d = int(doc[k])
        out[d] = (*out[d][:3], {"words": int(length[k]), "item": q.items[owner[k]], "at": int(spot[k] - first[d])})
    return out


def shards(texts: list[bytes], limit: int):
    """Consecutive texts of up to `limit` bytes together; a longer one is alone."""
    now, size = [], 0
    for text in texts:
        if now and size + len(text) > limit:
            yield now
            now, size = [], 0
        now.append(text)
        size += len(text)
    if now:
        yield now


def query_blocks(benchmark: DataFrame, limit: int = BLOCK_TEXT):
    """The benchmark's rows, a partition at a time, as blocks of up to `limit` bytes of text."""
    now, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    for name, text in rows.toLocalIterator():
        data = text.encode()
        if now and size + len(data) > limit:
            yield index_queries(now)
            now, size = [], 0
        now.append((name, data))
        size += len(data)
    if now:
        yield index_queries(now)


def grouped(batches, limit: int):
    """Batches, with their texts, in lists of up to `limit` bytes of text, of one at least."""
    held, size = [], 0
    for batch in batches:
        texts = texts_of(batch)
        n = sum(map(len, texts))
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append((batch, texts))
        size += n
    if held:
        yield held


def longer(a: dict | None, b: dict | None) -> dict | None:
    """The longer match; of equal ones the earlier in the text."""
    return max((x for x in (a, b) if x), key=lambda x: (x["words"], -x["at"]), default=None)


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, block_text: int = BLOCK_TEXT, shard_text: int = SHARD_TEXT, group_text: int = GROUP_TEXT) -> DataFrame:
    """A row a document: row (struct of the columns `keep`), n_words, spans (hit word ranges, apart), items, longest match
    (words, item, at which word), contaminated."""
    sc = docs.sparkSession.sparkContext
    rows = with_text(docs, keep)
    shared = [sc.broadcast(q) for q in query_blocks(benchmark, block_text)] or [sc.broadcast(index_queries([]))]
    result = row_schema(rows, f"n_words bigint, spans {SPANS}, items array<string>, longest {LONGEST}")
    kinds = {f.name: to_arrow_type(f.dataType) for f in result.fields[1:]}

    def scanned(batches):
        for group in grouped(batches, group_text if len(shared) > 1 else 0):
            found: list[list] = [[None] * len(texts) for _, texts in group]
            for block in shared:
                q = block.value
                for (_, texts), out in zip(group, found, strict=True):
                    got = [x for part in shards(texts, shard_text) for x in scan(q, part)]
                    out[:] = [x if a is None else (x[0], a[1] + x[1], a[2] + x[2], longer(a[3], x[3])) for a, x in zip(out, got, strict=True)]
                if len(shared) > 1:
                    del q, block._value  # it is read again from the executor's copy
            for (batch, _), out in zip(group, found, strict=True):
                cells = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds.values())]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *cells], names=["row", *kinds])

    out = rows.mapInArrow(scanned, result)
    # Spans of one block are apart and in order; those of several may overlap.
    step = lambda s, x: F.struct(F.greatest(s["end"], x["stop"]).alias("end"), (s["n"] + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(s["end"], x["start"]))).alias("n"))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    n_hit = F.aggregate(F.array_sort("spans"), zero, step, lambda s: s["n"])
    items = F.array_sort(F.array_distinct("items"))
    out = out.select("row", "n_words", n_hit.alias("n_hit"), "spans", items.alias("items"), "longest")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return find(docs, benchmark).where(~F.col("contaminated")).select("row.*")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    out = find(docs, benchmark, ["doc_id"])
    return out.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


SQL = r"""
WITH item_words AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
spots AS (
  SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT r, k, spots.n, item FROM spots JOIN windows ON spots.n = windows.n AND spots.win = windows.win),
hits AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM found)) GROUP BY r),
named AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
