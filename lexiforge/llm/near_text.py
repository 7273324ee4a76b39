"""Near dedup of whole texts: SimHash links by the trie self-join, and exact likeness of five-word shingles.

Two documents are linked when their SimHash fingerprints differ in two bits at most, or when the Jaccard likeness of their
sets of five-word shingles is 0.8 or more.  Candidates for the second come from bounds that lose no pair: shingles have one
order for the whole table (those common in a sample last, else by hash); of two alike sets of n and m the first
n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 in that order share a shingle (prefix filter).  Documents of such a shingle are
compared if their sizes and its places in both allow the likeness, then by parity prints (sets that differ in d shingles
differ in d bits at most; with four bits a shingle little below the likeness passes), and what is left is verified on the whole
sets: first one pair a document, then what the links found leave in different components.  The sample decides only the cost.

A shingle that the sample shows as common, or that over HOT documents hold, is crowded: no task takes its documents at once.
Every document meets LEADERS of them; then, of the components that the links so far leave, all but the largest meet all
members, dealt over cells of CHUNK by CHUNK documents.  Only pairs within one component are left out, so that no link between
components is lost at any size; the cost grows with the documents outside of a crowd's largest component times the crowd.  A pair
that shares one of both documents' first EARLIER crowded shingles is made there and not again at its other shared shingles.

Defined results: null text counts as empty; texts without words are alike; texts under five words are one shingle; texts of
any length are taken whole; rows with one doc_id, or with none, are documents of their own; the document with the smallest
doc_id of each group stays (null last, then the first row); an empty table gives an empty result; other columns, whatever
their names, are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.llm._shared import arrow_texts, discard, fresh, sized_broadcast, stored, text_or_empty, trimmed
from lexiforge.llm.simhash import components, links, simhash

SIMILARITY, SHINGLE = 0.8, 5
HOT, CHUNK, LEADERS = 32, 256, 3
#: Documents of the sample that orders shingles, its smallest share, and how many common shingles are kept.
SAMPLE, SHARE, COMMON = 20_000, 16, 100_000
STEP_ROWS = 200_000
#: Bits of a parity print: powers of two, this many times the set's size or more.
PARITY, LEAST_BITS, MOST_BITS = 4, 512, 1 << 16
#: Bytes of a shingle's hash that verification compares; two of a pair's shingles are equal by chance once in 2^40.
KEPT = 5
#: Pairs of one document that meet one copy of its set.
PAIRS_OF_ONE = 4096
#: Crowded keys of a document, its smallest ones, by which a pair that an earlier key has met is known.
EARLIER = 8
#: Words of parity prints that are compared at once.
COMPARED = 1_000_000


def shingles(data: bytes, size: int = SHINGLE):
    """Sorted distinct hashes of the word shingles; fewer words: the whole sequence."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    runs = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        runs = (runs ^ h[k : k + len(runs)]) * np.uint64(0xBF58476D1CE4E5B9)
        runs = (runs ^ (runs >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        runs ^= runs >> np.uint64(31)
    return np.unique(runs.view(np.int64))


def likeness(a, b) -> float:
    import numpy as np

    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def parity(found) -> bytes:
    """Per bit whether an odd number of shingles falls on it: sets that differ in d shingles differ in d bits at most.

    A print of twice the bits folds into one of half: its halves, one over the other.
    """
    import numpy as np

    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (PARITY * max(1, len(found)) - 1).bit_length()))
    spots = (found.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(spots.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(bits, words: int):
    """Rows of prints, as 64-bit words, folded to so many words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def packed(found) -> bytes:
    """The low KEPT bytes of each hash, sorted."""
    import numpy as np

    low = np.sort(found.view(np.uint64) & np.uint64((1 << 8 * KEPT) - 1))
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def unpacked(raw: bytes):
    import numpy as np

    wide = np.zeros((len(raw) // KEPT, 8), np.uint8)
    wide[:, :KEPT] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT)
    return wide.view("<u8").ravel()


def may_differ(n, m, similarity: float):
    """In how many shingles sets of n and m may differ; numbers, arrays or columns."""
    return (n + m) * ((1 - similarity) / (1 + similarity)) + 1e-6


def fits(n, m, i, j, similarity: float):
    """Whether sets of n and m with a shingle at places i and j can be alike: before and after it they differ by the lengths."""
    return abs(i - j) + abs((n - i) - (m - j)) <= may_differ(n, m, similarity)


def _texts(batch):
    data, ends = arrow_texts(batch.column(1))
    return (bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True))


def _sets(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([packed(shingles(x)) for x in _texts(batch)], pa.binary())], ["doc", "shingles"])


def _singly(batches):
    import pyarrow as pa

    for batch in batches:
        for text in _texts(batch):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(text))], ["shingle"])


def common_shingles(docs: DataFrame):
    """(hashes, counts) of shingles that several documents of a sample hold; sorted by hash."""
    import numpy as np

    share = max(SHARE, docs.count() // SAMPLE)
    sample = docs.select("doc", "text").filter(F.pmod(F.xxhash64("doc"), F.lit(share)) == 0)
    counts = sample.mapInArrow(trimmed(_singly), "shingle long").groupBy("shingle").count().filter("count > 2")
    top = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).toArrow()
    hashes, n = (np.asarray(top.column(k).combine_chunks()) for k in (0, 1))
    order = np.argsort(hashes)
    return hashes[order], n[order]


SKETCH = "doc long, print long, n long, digest binary, parity binary, first array<long>, rare int"


def _sketched(similarity: float, hashes, counts):
    """(doc, text) to SKETCH: the SimHash print, the size, a digest and the parity print of the set, and its first shingles

    in the order of the table, of which so many as `rare` says aren't common in the sample."""

    def one(text):
        import numpy as np
        from xxhash import xxh128_digest

        found, made = shingles(text), simhash(text)
        n, order, rare = len(found), found, len(found)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            weight = np.where(hashes[at] == found, counts[at], 0)
            order, rare = found[np.argsort(weight, kind="stable")], int((weight == 0).sum())
        first = order[: n - math.ceil(similarity * n - 1e-9) + 1]
        return made - (made >> 63 << 64), n, xxh128_digest(found.tobytes()), parity(found), first, min(rare, len(first))

    def sketched(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32())
        for batch in batches:
            made = list(zip(*map(one, _texts(batch)), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, made, kinds)], [x.split()[0] for x in SKETCH.split(", ")])

    return sketched


def sketches(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs (doc: distinct longs, text) to the stored SKETCH rows: the one pass over all texts."""
    return stored(docs.select("doc", "text").mapInArrow(trimmed(_sketched(similarity, *common_shingles(docs))), SKETCH), "sketch")


MEMBER = "key long, doc long, span long"  # span: size of the set << 32 | place of the key in it


def _members(sketch: DataFrame, start, length) -> DataFrame:
    rows = sketch.select("doc", "n", start.alias("start"), F.posexplode(F.slice("first", start + 1, length)).alias("at", "key"))
    return rows.select("key", "doc", F.shiftleft("n", 32).bitwiseOR((F.col("start") + F.col("at")).cast("long")).alias("span"))


def _candidates(similarity: float, hot: int):
    """MEMBER rows sorted by key to pairs (a, b, null, null) of keys of at most `hot` documents; rows of other keys come
    back as (key, doc, span) with b null, at once, so that no key is held."""

    def made(key, a, b, span):
        import pyarrow as pa

        columns = [pa.nulls(len(a), pa.int64()) if x is None else pa.array(x) for x in (key, a, b, span)]
        return pa.RecordBatch.from_arrays(columns, ["key", "a", "b", "span"])

    def solved(key, doc, span):
        import numpy as np

        n, place = span >> 32, span & 0xFFFFFFFF
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        left = np.repeat(starts + sizes, sizes) - np.arange(len(key)) - 1  # rows of the key after this one
        size = np.repeat(sizes, sizes)
        small, ends = np.flatnonzero((size > 1) & (size <= hot)), [np.zeros((0, 2), np.int64)]
        for d in range(1, hot):
            small = small[left[small] >= d]
            if not len(small):
                break
            i, j = small, small + d
            good = fits(n[i], n[j], place[i], place[j], similarity)
            i, j = doc[i[good]], doc[j[good]]
            ends.append(np.stack([np.minimum(i, j), np.maximum(i, j)], 1))
        pairs = np.unique(np.concatenate(ends), axis=0)
        yield made(None, pairs[:, 0], pairs[:, 1], None)
        crowd = np.flatnonzero(size > hot)
        yield made(key[crowd], doc[crowd], None, span[crowd])

    def candidates(batches):
        import numpy as np

        held, rows, streamed = [], 0, None
        for batch in batches:
            columns = [np.array(batch.column(k), np.int64) for k in range(3)]
            if streamed is not None and len(columns[0]):
                more = int(np.searchsorted(columns[0], streamed, "right"))
                yield made(columns[0][:more], columns[1][:more], None, columns[2][:more])
                columns = [x[more:] for x in columns]
                if not len(columns[0]):
                    continue
                streamed = None
            held.append(columns)
            rows += len(columns[0])
            if rows >= STEP_ROWS:
                columns = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = int(np.searchsorted(columns[0], columns[0][-1]))  # the rows of the last key wait for the rest
                if last:
                    yield from solved(*(x[:last] for x in columns))
                held, rows = [[x[last:] for x in columns]], rows - last
                if rows > hot:
                    streamed = columns[0][-1]
                    yield made(held[0][0], held[0][1], None, held[0][2])
                    held, rows = [], 0
        if rows:
            yield from solved(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return candidates


def _led(members: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of every member of a crowded key with the key's LEADERS: documents of the smallest hashes."""
    seeds = [F.min(F.struct(F.xxhash64("doc", F.lit(k)).alias("h"), "doc", "span")).alias(f"l{k}") for k in range(LEADERS)]
    chosen = members.groupBy("key").agg(*seeds)
    chosen = chosen.select("key", F.explode(F.array_distinct(F.array(*[F.struct(F.col(f"l{k}.doc").alias("lead"), F.col(f"l{k}.span").alias("of")) for k in range(LEADERS)]))).alias("l"))
    chosen = stored(chosen.select("key", "l.*"), "leaders")
    size, place = (lambda c: F.shiftright(c, 32)), (lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    n, m, i, j = size("span"), size("of"), place("span"), place("of")
    good = F.abs(i - j) + F.abs((n - i) - (m - j)) <= may_differ(n, m, similarity)
    rows = members.join(sized_broadcast(chosen, chosen.count()), "key").filter(good & (F.col("doc") != F.col("lead")))
    return rows.select(F.least("doc", "lead").alias("a"), F.greatest("doc", "lead").alias("b"))


class Prints:
    """Parity prints of several sizes."""

    def __init__(self, column):
        import numpy as np

        raw = column.to_pylist()
        self.words = np.array([len(x) // 8 for x in raw], np.int64)
        self.place, self.rows = np.zeros(len(raw), np.int64), {}
        for words in np.unique(self.words).tolist():
            own = np.flatnonzero(self.words == words)
            self.place[own] = np.arange(len(own))
            self.rows[words] = np.frombuffer(b"".join(raw[k] for k in own), np.uint64).reshape(len(own), words)

    def differ(self, a, other: Prints, b):
        """In how many bits the prints a and those b of the other differ, at the smaller size of each two; index arrays."""
        import numpy as np

        out, sizes = np.zeros(len(a), np.int64), self.words[a] * (1 << 20) + other.words[b]
        for size in np.unique(sizes).tolist():
            x, y = divmod(size, 1 << 20)
            at, least = np.flatnonzero(sizes == size), min(x, y)
            for k in range(0, len(at), max(1, COMPARED // least)):
                some = at[k : k + max(1, COMPARED // least)]
                one, two = (folded(p.rows[w][p.place[i[some]]], least) for p, w, i in ((self, x, a), (other, y, b)))
                out[some] = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
        return out


def _crossing(similarity: float):
    """Rows sorted by (key, lo, hi) to pairs (a, b) of different components that sizes, places and parity prints allow."""

    def solved(table):
        import numpy as np

        doc, root, span, probe, other = (table.column(c).to_numpy() for c in ("doc", "root", "span", "probe", "other"))
        prints, key = Prints(table.column("parity")), table.column("key")[0].as_py()
        low = np.full((len(doc), EARLIER), np.iinfo(np.int64).max)
        for k, own in enumerate(table.column("low").to_pylist()):
            low[k, : len(own)] = own
        n, place = span >> 32, span & 0xFFFFFFFF
        left, right = np.flatnonzero(probe), np.flatnonzero(~probe)
        for at in range(0, len(left), 64):
            i = left[at : at + 64, None]
            good = (root[i] != root[right]) & (~other[right] | (doc[i] > doc[right]))
            good &= fits(n[i], n[right], place[i], place[right], similarity)
            x, y = np.nonzero(good)
            x, y = left[at + x], right[y]
            near = prints.differ(x, prints, y) <= may_differ(n[x], n[y], similarity)
            x, y = x[near], y[near]
            met = np.zeros(len(x), bool)
            for k in range(EARLIER):
                met |= ((low[x, k, None] == low[y]).any(1)) & (low[x, k] < key)
            x, y = x[~met], y[~met]
            yield np.stack([np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y])], 1)

    def crossing(batches):
        import numpy as np
        import pyarrow as pa

        def made(held):
            for pairs in solved(pa.Table.from_batches(held)):
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")], 1)
            cuts = np.r_[0, np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1, len(cell)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and tuple(cell[a]) != last:
                    yield from made(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = tuple(cell[a])
        if held:
            yield from made(held)

    return crossing


def _verified(similarity: float):
    def verified(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = [likeness(unpacked(x[k].as_py()), unpacked(y[k].as_py())) >= similarity for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in (batch.column(0), batch.column(1))], ["a", "b"])

    return verified


def _near(similarity: float):
    """Pairs (a, b, n, m, x, y) to those whose parity prints x and y allow the likeness."""

    def near(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            x, y, all_ = Prints(batch.column(4)), Prints(batch.column(5)), np.arange(batch.num_rows)
            good = pa.array(x.differ(all_, y, all_) <= may_differ(n, m, similarity))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(good) for k in (0, 1)], ["a", "b"])

    return near


def _needed(pairs: DataFrame) -> DataFrame:
    return stored(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "needed")


def _with(pairs: DataFrame, end: str, rows: DataFrame, names: dict, often: DataFrame | None) -> DataFrame:
    """pairs joined on `end` with rows (doc, ...); a document of very many pairs (often) is copied, so that its pairs spread."""
    rows = rows.select(F.col("doc").alias(end), *[F.col(c).alias(new) for c, new in names.items()])
    if often is None:
        return pairs.join(rows, end)
    of = lambda df: df.join(often, F.col(end) == F.col("__doc"), "left").drop("__doc")
    other = "b" if end == "a" else "a"
    pairs = of(pairs).withColumn("__part", F.coalesce(F.pmod(F.xxhash64(other), "__parts"), F.lit(0)).cast("int")).drop("__parts")
    rows = of(rows).withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return pairs.join(rows, [end, "__part"]).drop("__part")


def _both(pairs: DataFrame, rows: DataFrame, names: dict, others: dict) -> DataFrame:
    """pairs, a stored table, with the columns of rows for a (names) and for b (others)."""
    often: dict = {"a": None, "b": None}
    if pairs.count() > PAIRS_OF_ONE:  # else no document has that many
        for end in often:
            many = pairs.groupBy(end).count().filter(F.col("count") > PAIRS_OF_ONE)
            many = stored(many.select(F.col(end).alias("__doc"), F.ceil(F.col("count") / PAIRS_OF_ONE).cast("int").alias("__parts")), "often")
            few = many.count()
            often[end] = sized_broadcast(many, few) if few else None
    return _with(_with(pairs, "a", rows, names, often["a"]), "b", rows, others, often["b"])


def _alike(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b), a stored table, whose shingle sets are alike."""
    pairs = pairs.select("a", "b")
    needed = _needed(pairs)
    texts = docs.select("doc", "text").join(sized_broadcast(needed, needed.count()), "doc", "left_semi")
    sets = stored(texts.mapInArrow(trimmed(_sets), "doc long, shingles binary"), "shingles")
    both = _both(pairs, sets, {"shingles": "x"}, {"shingles": "y"}).select("a", "b", "x", "y")
    out = stored(both.mapInArrow(trimmed(_verified(similarity)), "a long, b long"), "alike")
    discard(sets, needed)
    return out


def _close(pairs: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b), a stored table, that sizes and parity prints allow."""
    needed = _needed(pairs)
    rows = sketch.select("doc", "n", "parity").join(sized_broadcast(needed, needed.count()), "doc", "left_semi")
    both = _both(pairs, rows, {"n": "n", "parity": "x"}, {"n": "m", "parity": "y"}).select("a", "b", "n", "m", "x", "y")
    out = stored(both.mapInArrow(trimmed(_near(similarity)), "a long, b long"), "close")
    discard(needed)
    return out


def _joined(pairs: DataFrame, docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """pairs (a, b), a stored table, to edges of alike pairs that join what all alike ones join, and to (doc, root) of the edges.

    One pair a document, with the partner of the smallest hash, is verified first: most of the others fall into one component then.
    """
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one = both.groupBy("a").agg(F.min_by("b", F.struct(F.xxhash64("b"), "b")).alias("b"))
    one = stored(one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "one-pair")
    edges = _alike(one, docs, similarity)
    roots = components(edges).select(F.col("node").alias("doc"), "root")
    rest = pairs.join(one, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(roots.select(F.col("doc").alias(end), F.col("root").alias(f"r{end}")), end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    rest = stored(rest.filter("ra <> rb").select("a", "b", "ra", "rb"), "rest")
    if not rest.limit(1).count():
        return edges, roots
    more = _alike(rest, docs, similarity)
    # the components of the new links between the old components
    between = more.join(rest, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    tops = components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = roots.unionByName(tops.select(F.col("root").alias("doc"), "root")).distinct()  # roots of single documents count too
    roots = stored(known.join(tops, "root", "left").select("doc", F.coalesce("top", "root").alias("root")).distinct(), "roots")
    discard(one, rest)
    return edges.unionByName(more), roots


def _cells(members: DataFrame, sketch: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, lo, hi, ...): for every crowded key, the documents outside of its largest component against all."""
    labelled = stored(members.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc")), "labelled")
    sizes = labelled.groupBy("key", "root").count().groupBy("key").agg(F.sum("count").alias("all"), F.max(F.struct("count", "root")).alias("top"))
    chunks = lambda c: F.ceil(c / CHUNK).cast("int")
    sizes = sizes.filter(F.col("all") > F.col("top.count"))
    sizes = stored(sizes.select("key", F.col("top.root").alias("top"), chunks(F.col("all")).alias("los"), chunks(F.col("all") - F.col("top.count")).alias("his")), "crowds")
    low = members.groupBy("doc").agg(F.slice(F.array_sort(F.collect_list("key")), 1, EARLIER).alias("low"))
    rows = labelled.join(sized_broadcast(sizes, sizes.count()), "key").join(sketch.select("doc", "parity"), "doc").join(low, "doc")
    rows = rows.withColumn("other", F.col("root") != F.col("top"))
    lo, hi = F.pmod(F.xxhash64("doc"), "los").cast("int"), F.pmod(F.xxhash64("doc", F.lit(1)), "his").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "lo", "hi", "doc", "root", "span", "other", "probe", "parity", "low"]
    held = rows.withColumns({"lo": lo, "probe": F.lit(False)}).withColumn("hi", every("his")).select(columns)
    asking = rows.filter("other").withColumns({"hi": hi, "probe": F.lit(True)}).withColumn("lo", every("los")).select(columns)
    return held.unionByName(asking).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def alike_edges(docs: DataFrame, sketch: DataFrame, similarity: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """docs (doc, text) and their sketches to edges (a, b) that join all alike pairs, directly or through others."""
    # documents of one set are a star around their smallest; only that one meets others
    first = stored(sketch.groupBy("digest").agg(F.min("doc").alias("b"), F.count("*").alias("count")).filter("count > 1").select("digest", "b"), "sets")
    again = stored(sketch.select("doc", "digest").join(sized_broadcast(first, first.count(), 100_000), "digest").filter("doc <> b").select(F.col("doc").alias("a"), "b"), "stars")
    single = sketch.join(sized_broadcast(again.select(F.col("a").alias("doc")), again.count()), "doc", "left_anti").select("doc", "n", "first", "rare")
    keyed = _members(single, F.lit(0), F.col("rare")).repartition("key").sortWithinPartitions("key")
    found = stored(keyed.mapInArrow(trimmed(_candidates(similarity, hot)), "key long, a long, b long, span long"), "found")
    members = found.filter("b is null").select("key", F.col("a").alias("doc"), "span")
    members = stored(members.unionByName(_members(single, F.col("rare"), F.size("first") - F.col("rare"))), "members")
    pairs = found.filter("b is not null").select("a", "b").unionByName(_led(members, similarity))
    pairs = stored(pairs.distinct(), "pairs")
    close = _close(pairs, sketch, similarity)
    edges, roots = _joined(close, docs, similarity)
    discard(first, found, pairs, close)
    if members.limit(1).count():
        crossing = stored(_cells(members, sketch, roots).mapInArrow(trimmed(_crossing(similarity)), "a long, b long").distinct(), "crossing")
        edges = edges.unionByName(_joined(crossing, docs, similarity)[0])
        discard(crossing)
    discard(members)
    return edges.unionByName(again)


def similar(docs: DataFrame, similarity: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """docs (doc: distinct longs, text) to edges (a, b) that join all alike pairs, directly or through others."""
    return alike_edges(docs, sketches(docs, similarity), similarity, hot)


def print_edges(sketch: DataFrame) -> DataFrame:
    """Edges (a, b) that join all documents whose SimHash prints are linked."""
    # rows of one print are a star around their smallest row; other links run between the stars' centres
    first = stored(sketch.groupBy("print").agg(F.min("doc").alias("first"), F.count("*").alias("count")), "first")
    many = first.filter("count > 1")
    stars = sketch.select("doc", "print").join(sized_broadcast(many.select("print", "first"), many.count()), "print").filter("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    between = stored(links(first.select("print")), "print-links")
    x, y = (first.select(F.col("print").alias(end), F.col("first").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    return stars.unionByName(between.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each group: linked by SimHash (two of 64 bits) or by likeness; columns as before."""
    own, row, gone = docs.columns, *fresh(docs, "row", "gone")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ids = slim.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
    if len(set(ids)) > 1:  # ids that are null or stand in several rows: a key for each row, on rows that stay as they are
        docs = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        slim, key = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(row).alias("doc")), F.col(row)
    else:
        slim, key = slim.withColumn("doc", F.col("doc_id")), F.col(id_col).cast("long")
    sketch = sketches(slim, similarity)
    edges = stored(print_edges(sketch).unionByName(alike_edges(slim, sketch, similarity)), "links")
    groups = components(edges)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "doc")
    ranked = slim.select("doc", "doc_id").join(groups.select(F.col("node").alias("doc"), "root"), "doc")
    ranked = stored(ranked.select("doc", "root", order.alias("o")), "ranked")
    stays = ranked.groupBy("root").agg(F.min("o").alias("o")).select(F.col("o.doc").alias("doc"))
    lost = stored(ranked.select(F.col("doc").alias(gone)).join(stays.select(F.col("doc").alias(gone)), gone, "left_anti"), "near-lost")
    discard(sketch, edges, ranked)
    return docs.join(sized_broadcast(lost, lost.count()), key == F.col(gone), "left_anti").select(*own)
