"""SimHash near-dedup: a binary trie self-join over 64-bit fingerprints.

A pair within two bits agrees on two of four 16-bit blocks, so that six keys of 32 bits bring every such pair together.
Inside a key the distinct fingerprints, sorted, are a binary trie of ranges: node pairs are traversed together from the
root, a bit that differs adds one, and a pair over the budget is dropped.  A key with over HOT fingerprints is dealt anew
by 28 keys of 48 bits (six of eight blocks), which hold 65,536 different fingerprints at most; no pair is lost.

Within a task the links found become stars (a union of the links, one edge per fingerprint); the stars are contracted on
the cluster: each fingerprint hooks to its smallest neighbour, pointers are halved, edges are relabelled, until none is left.

Defined results: null text counts as empty (fingerprint zero, linked like any other); equal fingerprints are one node; a
null doc_id is larger than others; repeated rows are rows like others; a bit set in exactly half the shingles is 0; texts of any
length are read whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import arrow_texts, discard, read_table, sized_broadcast, stored

BUDGET, SHINGLE, SEED = 2, 3, 42
HOT = 4096
#: Rows of the sorted keys that one step of the traversal takes, and node pairs held at once.
STEP_ROWS, FRONTIER = 200_000, 500_000


def simhash(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # of bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter((xxh64_intdigest(x, seed) for x in runs), np.uint64)
    spots = (h.astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)).ravel()
    per_value = np.bincount(spots, minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    counts = per_value @ bits  # byte by bit
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(h), bitorder="little").tobytes(), "little")


def _prints(batches):
    import pyarrow as pa

    for batch in batches:
        data, ends = arrow_texts(batch.column(1))
        made = [simhash(bytes(data[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x - (x >> 63 << 64) for x in made], pa.int64())], ["doc_id", "print"])


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_prints, "doc_id long, print long")


def trie_pairs(keys, values, budget: int = BUDGET, frontier: int = FRONTIER):
    """Yields index arrays (i, j) of pairs within budget bits; keys and (unsigned, distinct per key) values are sorted.

    values: one row of 64-bit words per fingerprint, or a plain array of one word each.
    """
    import numpy as np

    n = len(keys)
    words = values.reshape(n, -1) if n else values.reshape(0, 1)
    width = 64 * words.shape[1]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    first = (starts[many], ends[many], starts[many], ends[many], np.zeros(many.sum(), np.int16))
    stack, ones, at = [(width - 1, first)], None, None
    while stack:
        bit, (alo, ahi, blo, bhi, diff) = stack.pop()
        while bit >= 0 and len(alo):
            if len(alo) > frontier:
                half = len(alo) // 2
                stack.append((bit, tuple(x[half:] for x in (alo, ahi, blo, bhi, diff))))
                alo, ahi, blo, bhi, diff = (x[:half] for x in (alo, ahi, blo, bhi, diff))
            if at != bit:
                column = words[:, (width - 1 - bit) // 64]
                ones, at = np.r_[0, np.cumsum((column >> np.uint64(bit % 64)) & np.uint64(1), dtype=np.int64)], bit
            amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
            own = alo == blo
            parts = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1)]
            parts.append(tuple(x[~own] for x in (amid, ahi, blo, bmid, diff + 1)))
            alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep = (ahi > alo) & (bhi > blo) & (diff <= budget) & ((alo != blo) | (ahi - alo > 1))
            alo, ahi, blo, bhi, diff = (x[keep] for x in (alo, ahi, blo, bhi, diff))
            single = (ahi - alo == 1) & (bhi - blo == 1)
            if single.any():  # the bits that are left are compared at once
                i, j = alo[single], blo[single]
                near = np.bitwise_count(words[i] ^ words[j]).sum(1, dtype=np.int64) <= budget
                yield i[near], j[near]
                alo, ahi, blo, bhi, diff = (x[~single] for x in (alo, ahi, blo, bhi, diff))
            bit -= 1


def local_roots(n: int, pairs):
    """The smallest index that each of n nodes reaches over the pairs."""
    import numpy as np

    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def _stars(batches):
    """Sorted (key, print) rows to edges (a, b) from each linked fingerprint to the first of its links' union."""
    import numpy as np
    import pyarrow as pa

    def solved(keys, values):
        order = np.lexsort((values.view(np.uint64), keys))
        keys, values = keys[order], values[order]
        root = local_roots(len(keys), trie_pairs(keys, values.view(np.uint64)))
        linked = np.flatnonzero(root != np.arange(len(keys)))
        edges = np.unique(np.stack([values[linked], values[root[linked]]], 1), axis=0) if len(linked) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])

    held, rows = [], 0
    for batch in batches:
        keys, values = (np.array(batch.column(k), np.int64) for k in (0, 1))
        held.append((keys, values))
        rows += len(keys)
        if rows >= STEP_ROWS:
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(keys, keys[-1]))  # the rows of the last key wait for the rest
            if last:
                yield solved(keys[:last], values[:last])
            held, rows = [(keys[last:], values[last:])], len(keys) - last
    if rows:
        yield solved(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _keyed(values: DataFrame, blocks: int, budget: int = BUDGET) -> DataFrame:
    """(key, print): every choice of all blocks but `budget` of the 64 bits."""
    wide = 64 // blocks
    block = lambda i: F.shiftrightunsigned("print", wide * i).bitwiseAND(F.lit((1 << wide) - 1))
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - budget)):
        key = F.lit(k).cast("long")
        for i in chosen:
            key = F.shiftleft(key, wide).bitwiseOR(block(i))
        keys.append(key)
    return values.select(F.explode(F.array(*keys)).alias("key"), "print")


def links(values: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that join all pairs of the distinct fingerprints within the budget, directly or through others."""
    keyed = _keyed(values, 4)
    crowded = stored(keyed.groupBy("key").count().filter(F.col("count") > hot).select("key"), "hot-keys")
    n = crowded.count()
    dealt = keyed
    if n:
        crowded = sized_broadcast(crowded, n)
        dealt = keyed.join(crowded, "key", "left_anti")
        again = keyed.join(crowded, "key", "left_semi").select("print").distinct()
        dealt = dealt.unionByName(_keyed(again, 8).withColumn("key", -1 - F.col("key")))
    sorted_keys = dealt.repartition("key").sortWithinPartitions("key", "print")
    return sorted_keys.mapInArrow(_stars, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is a node of the same component."""
    edges = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges-0")
    found, turn = None, 0
    while edges.limit(1).count():
        turn += 1
        hook = edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hook, moved = stored(hook, f"hooks-{turn}"), True
        while moved:  # halve the ways to the roots
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = hook.join(up, "root").select("node", F.col("root").alias("old"), F.col("top").alias("root"))
            jumped = jumped.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("old")).alias("moved"))
            jumped = stored(jumped, f"jumps-{turn}")
            moved = jumped.filter("moved").limit(1).count()
            discard(hook)
            hook = jumped
        if found is None:
            found = hook.select("node", "root")
            found.lexiforge_path = hook.lexiforge_path
        else:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
            before, found = found, stored(found.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), f"roots-{turn}")
            discard(before)
        before = edges
        for end in ("a", "b"):
            edges = edges.join(hook.select(F.col("node").alias(end), F.col("root").alias("__root")), end).drop(end).withColumnRenamed("__root", end)
        edges = stored(edges.select("a", "b").filter("a <> b").distinct(), f"edges-{turn}")
        discard(before)
        if turn > 1:
            discard(hook)
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, fingerprint, component_id)."""
    rows = stored(prints(docs, id_col, text_col), "prints")
    values = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "values")
    roots = components(links(values.select("print"))).select(F.col("node").alias("print"), "root")
    values = stored(values.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")), "rooted")
    least = stored(values.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of = stored(values.join(least, "root").select("print", "component_id"), "components")
    return rows.join(of, "print", "left").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read_table(spark, sf_dir, "documents"))
