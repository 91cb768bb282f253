"""Near duplicates by SimHash: BK-trees over shards of the distinct fingerprints.

1. One map computes each document's fingerprint; equal fingerprints fold into one row with their smallest doc_id.
2. Two fingerprints within RADIUS bits agree on at least n - RADIUS of n bit blocks, so every pair to be linked meets in a shard of
   one of the choices of that many blocks. Six blocks make 15 shards of some 21 bits for each fingerprint; n grows with the number of
   fingerprints, so that a shard's expected size stays below one tree.
3. A task walks its shards in order, builds their BK-trees (a child hangs from its parent by their integer Hamming distance)
   and looks every fingerprint up in its shard's tree, following only the edges whose distance the triangle inequality allows.
   It keeps a spanning star of each linked group, never the pairs.
4. The fingerprints of a shard that would be more than MOST trees are dealt again, by FINE blocks: 210 shards of some 38 bits.
   A shard with more than TREE fingerprints is cut into trees of at most TREE. Each tree goes to the units that look up
   one tree's fingerprints in another (or in itself), so no task holds more than two trees however large the shard is.
5. The stars are joined into groups by alternating large-star and small-star steps until nothing changes.
6. Fingerprints that more than one in HOT rows have, of which there are fewer than HOT, are joined to their rows by broadcast;
   only the others are shuffled by fingerprint.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other; repeated rows and exact copies
share a fingerprint and so a group; null doc_ids take part, a group of nothing else has a null id; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tramlake.llm.common import as_bytes, cut, spacing, whole_row, word_blocks

SHINGLE, RADIUS = 4, 4
#: Least number of blocks, and that of crowded shards.
BLOCKS, FINE = 6, 10
#: Fingerprints in a tree, and trees of a shard from which on it is crowded.
TREE, MOST = 8192, 32
#: A fingerprint is hot if more than one in so many rows have it.
HOT = 1000
#: (query, node) pairs that a lookup holds at once.
PAIRS = 1 << 19
#: Linked pairs in a partition.
EDGES = 200_000
TABLE = spacing(b"\t\n\x0b\x0c\r ")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit k is 1 if it is set in over half of the XXH64 (seed 42) of the word shingles, repeats included."""
    votes, n, carry, digest = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in word_blocks(text.translate(TABLE)):
        words = carry + words
        carry = words[1 - shingle :]
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], stops[:-shingle] + 1)).tolist()
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops[shingle - 1 :].tolist(), strict=True)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n:
        return digest(b" ".join(carry), 42) if carry else 0
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, **more: Column) -> DataFrame:
    """doc_id, the columns `more`, and fp, the fingerprint as a signed long."""
    kept = docs.select("doc_id", *(c.alias(name) for name, c in more.items()), as_bytes("text").alias("text"))

    def printed(batches):
        for batch in batches:
            prints = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])

    return kept.mapInArrow(printed, T.StructType([*kept.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """For each choice of blocks - radius blocks, the bits that they cover, as signed longs."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    cover = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x - (1 << 64) if (x := sum(chosen)) >> 63 else x for chosen in combinations(cover, blocks - radius)]


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [lo, hi), and the number of the range of each."""
    n = hi - lo
    own = np.repeat(np.arange(len(lo)), n)
    return np.arange(len(own)) - np.repeat(np.cumsum(n) - n - lo, n), own


def bk_forest(fps: np.ndarray, group: np.ndarray):
    """BK-trees of all groups at once: root of each group, then (parent * 65 + distance) and child, sorted by the former.

    The first fingerprint that hangs from a node at a distance becomes the child there, and those that hang at the same
    distance move below it: the tree that one insertion after the other gives.
    """
    n = len(fps)
    order = np.argsort(group, kind="stable")
    slot = group[order].astype(np.int64)
    keys, children, roots = [], [], None
    while len(order):
        head = np.concatenate(([True], slot[1:] != slot[:-1]))
        lead = order[head]
        if roots is None:
            roots = dict(zip(slot[head].tolist(), lead.tolist(), strict=True))
        else:
            keys.append(slot[head])
            children.append(lead)
        above = np.repeat(lead, np.diff(np.concatenate((np.flatnonzero(head), [len(order)]))))
        rest, above = order[~head], above[~head]
        slot = above * 65 + np.bitwise_count(fps[rest] ^ fps[above]).astype(np.int64)
        by = np.argsort(slot, kind="stable")
        order, slot = rest[by], slot[by]
    edge = np.concatenate(keys) if keys else np.empty(0, np.int64)
    child = np.concatenate(children) if children else np.empty(0, np.int64)
    by = np.argsort(edge, kind="stable")
    return roots, edge[by], child[by]


def linked(fps: np.ndarray, tree_of: np.ndarray, queries: np.ndarray, asks: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Look up fps[queries] in the trees that `asks` names (tree_of: each fingerprint's tree, below 0 for none).

    Returns for each fingerprint the least index that it is linked to through found pairs.
    """
    label = np.arange(len(fps))
    inside = np.flatnonzero(tree_of >= 0)
    roots, edge, child = bk_forest(fps[inside], tree_of[inside])
    root = np.array([roots.get(t, -1) for t in asks.tolist()], np.int64)
    queries, root = queries[root >= 0], root[root >= 0]
    sizes = np.bincount(tree_of[inside])
    load = np.cumsum(sizes[tree_of[inside][root]]) if len(root) else np.empty(0)
    for part in np.split(np.arange(len(queries)), np.flatnonzero(np.diff(load // PAIRS)) + 1) if len(queries) else []:
        q, node, found = queries[part], root[part], []
        while len(q):
            far = np.bitwise_count(fps[q] ^ fps[inside[node]]).astype(np.int64)
            hit = (far <= radius) & (label[q] != label[inside[node]])
            found.append((q[hit], inside[node[hit]]))
            below, own = expand(np.searchsorted(edge, node * 65 + np.maximum(far - radius, 0)), np.searchsorted(edge, node * 65 + np.minimum(far + radius, 64), "right"))
            q, node = q[own], child[below]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        label = merged(label, a, b)
    return label


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the least index of each group) after joining the pairs a, b."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def stars(fps: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    own = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(fps[own].view(np.int64)), pa.array(fps[label[own]].view(np.int64))], names=["a", "b"])


def in_shards(batches, tree: int = TREE):
    """Sorted (shard, fp) rows to stars of the shards of up to `tree` fingerprints, and the rows of larger ones with their place.

    Output: kind 0: a, b are linked; kind 1: fingerprint a of shard b is the `place`-th there.
    """
    held_s, held_f, large, place = np.empty((0, 2), np.int64), np.empty(0, np.uint64), None, 0

    def out(kind, a, b, place):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b[:, 0]), pa.array(b[:, 1]), pa.array(place)], names=["kind", "a", "b", "mask", "place"])

    def close(shard, fps):
        """Stars of complete shards, singles left out."""
        head = np.concatenate(([True], (shard[1:] != shard[:-1]).any(axis=1)))
        group = np.cumsum(head) - 1
        several = np.bincount(group)[group] > 1
        fps, group = fps[several], group[several]
        if len(fps):
            label = linked(fps, group, np.arange(len(fps)), group)
            own = np.flatnonzero(label != np.arange(len(label)))
            to = fps[label[own]].view(np.int64)
            yield out(0, fps[own], np.stack([to, np.zeros_like(to)], 1), np.zeros(len(own), np.int64))

    for batch in batches:
        if not batch.num_rows:
            continue
        shard = np.concatenate((held_s, np.stack([batch.column("shard").to_numpy(), batch.column("mask").to_numpy()], 1)))
        fps = np.concatenate((held_f, batch.column("fp").to_numpy().view(np.uint64)))
        if large is not None:  # the rest of a shard that was too large
            same = (shard == large).all(axis=1)
            yield out(1, fps[same], shard[same], place + np.arange(int(same.sum()), dtype=np.int64))
            place += int(same.sum())
            shard, fps = shard[~same], fps[~same]
            if not len(fps):
                held_s, held_f = shard, fps
                continue
            large = None
        head = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]).any(axis=1))))
        size = np.diff(np.concatenate((head, [len(fps)])))
        for k in np.flatnonzero(size > tree).tolist():
            part = slice(head[k], head[k] + size[k])
            yield out(1, fps[part], shard[part], np.arange(size[k], dtype=np.int64))
            if k == len(size) - 1:
                large, place = shard[-1], int(size[k])
        small = np.repeat(size <= tree, size)
        last = np.arange(len(fps)) >= head[-1]
        done = small & ~last
        if done.any():
            yield from close(shard[done], fps[done])
        held_s, held_f = shard[small & last], fps[small & last]
    if len(held_f):
        yield from close(held_s, held_f)


def in_units(batches):
    """Rows sorted by unit (of a large shard: tree i, fingerprints j) to stars; a unit has two trees' rows at most."""

    def close(rows):
        fps, tree, ask = rows
        label = linked(fps, np.where(tree, 0, -1), np.flatnonzero(ask), np.zeros(int(ask.sum()), np.int64))
        return stars(fps, label)

    held, now = [], None
    for batch in batches:
        unit = list(zip(*(batch.column(c).to_numpy().tolist() for c in ("shard", "mask", "i", "j")), strict=True))
        fps, tree, ask = batch.column("fp").to_numpy().view(np.uint64), batch.column("tree").to_numpy(zero_copy_only=False), batch.column("ask").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(unit):
            stop = at
            while stop < len(unit) and unit[stop] == unit[at]:
                stop += 1
            if now is not None and unit[at] != now:
                yield close([np.concatenate(x) for x in zip(*held, strict=True)])
                held = []
            now = unit[at]
            held.append((fps[at:stop], tree[at:stop], ask[at:stop]))
            at = stop
    if held:
        yield close([np.concatenate(x) for x in zip(*held, strict=True)])


def blocks_for(n: int, tree: int = TREE, radius: int = RADIUS) -> int:
    """The least number of blocks by which n evenly spread fingerprints make shards of a quarter of a tree at most."""
    return next(b for b in range(BLOCKS, 65) if n >> 64 * (b - radius) // b <= tree // 4 or b == 16)


def walked(distinct: DataFrame, blocks: int, tree: int) -> tuple[DataFrame, DataFrame]:
    """Stars (a, b) of the shards of up to `tree` fingerprints, and the rows of larger ones: shard, mask, fp, own (number of the tree)."""
    masks = F.explode(F.array(*map(F.lit, block_masks(blocks))))
    keyed = distinct.select("fp", masks.alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("shard"))
    keyed = keyed.repartition("mask", "shard").sortWithinPartitions("mask", "shard")
    rows = cut(keyed.mapInArrow(lambda batches: in_shards(batches, tree), "kind int, a bigint, b bigint, mask bigint, place bigint"))
    large = rows.where("kind = 1").select(F.col("b").alias("shard"), "mask", F.col("a").alias("fp"), F.floor(F.col("place") / tree).alias("own"))
    return rows.where("kind = 0").select("a", "b"), large


def paired(large: DataFrame) -> DataFrame:
    """Stars (a, b) of shards of several trees, from rows with `last`, the number of the shard's last tree."""
    units = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    units = units.select(
        "shard", "mask", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("tree"), (F.col("own") >= F.col("other")).alias("ask"),
    )
    order = ["shard", "mask", "i", "j"]
    return units.repartition(*order).sortWithinPartitions(*order).mapInArrow(in_units, "a bigint, b bigint")


def links(distinct: DataFrame, tree: int = TREE, most: int = MOST) -> DataFrame:
    """Stars (a, b) that join all distinct fingerprints (column fp) within RADIUS bits of each other."""
    numbered = lambda large: large.join(large.groupBy("shard", "mask").agg(F.max("own").alias("last")), ["shard", "mask"])
    found, large = walked(distinct, blocks_for(distinct.count(), tree), tree)
    large = numbered(large)
    found = found.union(paired(large.where(F.col("last") < most)))
    crowded = large.where(F.col("last") >= most).select("fp").distinct()
    if not crowded.isEmpty():
        fine, large = walked(crowded, FINE, tree)
        found = found.union(fine).union(paired(numbered(large)))
    return found.distinct()


def grouped(edges: DataFrame, most: int = 50) -> DataFrame:
    """(a, b) pairs of longs to (node, root): root is the least node of the group, and listed too; only nodes with a pair are listed."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen, parts = None, edges.count() // EDGES + 1  # a step never makes more pairs
    for _ in range(most):
        # Large-star: a node's larger neighbours move to its least neighbour (or itself).
        both = edges.union(edges.select("b", "a"))
        # Written first: a join of two plain shuffles is one whose hot keys, such as a root with very many neighbours, can be split.
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).coalesce(parts))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        # Small-star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        # As many partitions as the pairs need, not as many as the corpus does: each would be a task and a file.
        edges = cut(small.union(least.select("a", F.col("root").alias("b"))).distinct().coalesce(parts))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            # In as many partitions as the pairs again, which the roots alone would not be.
            return cut(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct()).coalesce(parts))
        seen = now
    raise RuntimeError("groups did not settle")


def groups_of(prints: DataFrame, tree: int = TREE) -> DataFrame:
    """One row a fingerprint, from rows with doc_id and fp: fp, n (its rows), first (the least of `first` of its rows, if they have it),
    root (the least fp of its group) and component_id (the group's smallest doc_id)."""
    first = [F.min("first").alias("first")] if "first" in prints.columns else []
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"), *first))
    members = grouped(links(distinct.select("fp"), tree)).withColumnRenamed("node", "fp")
    linked = members.join(distinct, "fp")
    # The smallest ids of the groups with links, written first so that a group of very many members can be split.
    lows = cut(linked.groupBy("root").agg(F.min("low").alias("least")))
    named = linked.join(lows, "root").select("fp", "root", "least", F.lit(True).alias("in_group"))
    own = F.when(F.col("in_group"), F.col("least")).otherwise(F.col("low"))
    return distinct.join(named, "fp", "left").select("fp", "n", *(["first"] if first else []), F.coalesce("root", "fp").alias("root"), own.alias("component_id"))


def near_duplicates(docs: DataFrame, tree: int = TREE) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row."""
    prints = cut(fingerprints(docs))
    found = cut(groups_of(prints, tree).select("fp", "n", "component_id"))
    limit = prints.count() / HOT
    # Fewer than HOT fingerprints can have more than one in HOT rows.
    hot = F.broadcast(found.where(F.col("n") > limit).select("fp", "component_id", F.lit(True).alias("hot")))
    rows = prints.join(hot, "fp", "left")
    others = rows.where("hot IS NULL").select("fp", "doc_id").join(found.where(F.col("n") <= limit), "fp")
    return rows.where("hot").select("doc_id", "fp", "component_id").union(others.select("doc_id", "fp", "component_id"))


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row, its nulls included."""
    plain = [c if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType) else F.to_json(F.struct(c)) for f in docs.schema.fields for c in [F.col(f"`{f.name}`")]]
    return F.xxhash64(*plain, *(F.isnull(F.col(f"`{c}`")) for c in docs.columns))


def first_of_each(docs: DataFrame, tree: int = TREE) -> DataFrame:
    """One row of each group, with all its columns: the first by (doc_id, nulls last; fingerprint; hash of the row).

    A row is known by its doc_id and hash, so rows that share a doc_id or have none are judged one by one; of rows that are equal in
    every column one stays.
    """
    prints = cut(fingerprints(docs, hash=row_hash(docs))).withColumn("first", F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "hash"))
    found = groups_of(prints, tree)
    first = found.groupBy("root").agg(F.min(F.struct("first.unnamed", "first.doc_id", "fp", "first.hash")).alias("f"))
    kept = cut(first.select(F.col("f.doc_id").alias("kept_id"), F.col("f.hash").alias("kept_hash")))
    equal = cut(prints.groupBy(F.col("doc_id").alias("equal_id"), F.col("hash").alias("equal_hash")).agg(F.count("*").alias("n")).where("n > 1"))
    repeated = F.col("kept_id").eqNullSafe(F.col("equal_id")) & (F.col("kept_hash") == F.col("equal_hash"))
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("id"), row_hash(docs).alias("hash"))
    same = lambda name: F.col("id").eqNullSafe(F.col(f"{name}_id")) & (F.col("hash") == F.col(f"{name}_hash"))
    # Rows that more than one in HOT rows repeat, of which there are fewer than HOT, needn't be shuffled to find that they aren't single.
    hot = F.broadcast(equal.where(F.col("n") > prints.count() / HOT).drop("n"))
    single = rows.join(hot, same("equal"), "left_anti").join(kept.join(equal, repeated, "left_anti"), same("kept"), "left_semi")
    several = rows.join(kept.join(equal, repeated, "left_semi"), same("kept"), "left_semi").dropDuplicates(["id", "hash"])
    return single.union(several).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
