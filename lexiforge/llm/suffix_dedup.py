"""Suffix-array dedup: removes every byte covered by a LENGTH-byte string that starts twice or more anywhere.

Sparse suffixes.  Every window of LENGTH bytes has an anchor: its GRAM-byte run with the smallest hash, leftmost on ties.
Equal windows have equal anchors at the same place, so only suffixes at anchors need sorting.  Consecutive windows with one
anchor are a segment (gram hash, hash of its bytes, document, place).
1. A gram that anchors one segment only: its windows are unique.  One kind of segment only: all its windows repeat.
2. Else the gram's kinds of segments differ somewhere (the edges of repeats): one of each kind is fetched with its bytes,
   and the suffixes at the anchors are sorted, to the right and, mirrored, to the left.  Comparisons take prefix polynomial
   hashes: a binary search finds the common extension of two suffixes, so a comparison in the vectorised mergesort is
   logarithmic; neighbours in the final order are verified byte by byte, and a group with a collision is sorted by bytes.
   Two windows around the anchor are equal when they lie in one class of both orders, cut at the extensions wanted.
3. A gram with over HOT kinds (a line or passage that very many documents share) is split: blocks of windows go by the
   hash of the bytes that all of the block's windows hold; blocks whose bytes stand there once are unique, the others are
   compared window by window by a 128-bit hash in an aggregation.  So no group of any size meets in one task.

A gram or kind that very many segments have is dealt over several keys in the joins.

Defined results: null text is empty (0 bytes, no spans); texts under LENGTH bytes lose nothing; repeated rows are documents
of their own and repeat each other; null or repeated doc_id are allowed; texts of any length are read whole, in slices that
overlap; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import arrow_texts, discard, read_table, salted_join, stored, text_or_empty

LENGTH, GRAM = 200, 64
WIDE = LENGTH - GRAM + 1
HOT, BLOCK = 256, 17
#: Bytes whose hashes are held at once; an index fits PLACE bits.
SLICE, PLACE = 1_000_000, 20
#: Segments that one step of the suffix sort takes.
STEP_ROWS = 40_000


def _tables(n: int):
    """Random bytes' values, powers of an odd base and of its inverse, modulo 2^64."""
    import numpy as np

    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    powers = lambda x: np.cumprod(np.r_[np.uint64(1), np.full(n, x, np.uint64)], dtype=np.uint64)
    return values, powers(base), powers(pow(base, -1, 1 << 64))


def prefix_hashes(data, tables):
    """H with hash(data[a:b]) = (H[b] - H[a]) * inverse_power[a]."""
    import numpy as np

    values, powers, _ = tables
    return np.r_[np.uint64(0), np.cumsum(values[data] * powers[: len(data)], dtype=np.uint64)]


def sliding_minimum(x, wide: int):
    """Minimum of every `wide` consecutive values: of blocks' prefix and suffix minima."""
    import numpy as np

    n = len(x)
    padded = np.concatenate([x, np.full(-n % wide, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - wide + 1], ahead[wide - 1 : n])


def segments_of(data, ok, tables):
    """data: bytes (uint8), ok: which windows count.  Arrays (first window, last window, anchor, gram hash)."""
    import numpy as np

    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = prefix_hashes(data, tables)
    grams = (h[GRAM:] - h[:-GRAM]) * tables[2][: len(data) - GRAM + 1]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    low = np.uint64((1 << PLACE) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_minimum(packed, WIDE) & low).astype(np.int64)
    at = np.flatnonzero(ok[: len(anchor)])
    if not len(at):
        return at, at, at, grams[:0]
    own = anchor[at]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    first, last = at[new], at[np.r_[new[1:], len(at)] - 1]
    return first, last, own[new], grams[own[new]]


def _segments(batches):
    """(doc, text) to segments (g, s, doc, place); place = first window << 16 | windows - 1 << 8 | anchor - first."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_64_intdigest

    tables = _tables(SLICE + LENGTH)
    half = 1 << 63

    def solved(parts):
        """parts: (doc, offset in the document, bytes)"""
        joined = b"".join(p[2] for p in parts)
        view, data = memoryview(joined), np.frombuffer(joined, np.uint8)
        sizes = np.array([len(p[2]) for p in parts])
        begins = np.cumsum(sizes) - sizes
        ok = np.zeros(len(data), bool)
        for a, n in zip(begins, sizes, strict=True):
            ok[a : a + n - LENGTH + 1] = True
        first, last, anchor, grams = segments_of(data, ok, tables)
        of = np.searchsorted(begins, first, "right") - 1
        s = [xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
        place = (first - begins[of] + np.array([p[1] for p in parts])[of] << 16) | (last - first << 8) | (anchor - first)
        docs = np.array([p[0] for p in parts])[of]
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array([x - (x >= half) * 2 * half for x in s], pa.int64()), pa.array(docs), pa.array(place)], ["g", "s", "doc", "place"])

    for batch in batches:
        data, ends = arrow_texts(batch.column(1))
        parts, held = [], 0
        for doc, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            for at in range(0, b - a - LENGTH + 1, SLICE - LENGTH):
                piece = data[a + at : min(b, a + at + SLICE - 1)]
                if len(piece) < LENGTH:
                    continue
                if held + len(piece) > SLICE:
                    yield solved(parts)
                    parts, held = [], 0
                parts.append((doc, at, piece))
                held += len(piece)
        if parts:
            yield solved(parts)


SEGMENT = "g long, s long, doc long, place long"
FETCHED = "g long, n long, doc long, place long, content binary"


def _fetch(batches):
    """(doc, text, gs, ns, places) to FETCHED rows."""
    import pyarrow as pa

    names = [x.split()[0] for x in FETCHED.split(", ")]
    for batch in batches:
        data, ends = arrow_texts(batch.column(1))
        out, size = [], 0
        for doc, a, gs, ns, places in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), *(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            for g, n, place in zip(gs, ns, places, strict=True):
                first = a + (place >> 16)
                content = bytes(data[first : first + (place >> 8 & 255) + LENGTH])
                out.append((g, n, doc, place, content))
                size += len(content)
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def extension(h, inverse, x, y, most):
    """How many bytes (at most `most`) agree from x and y on; arrays, by binary search over prefix hashes."""
    import numpy as np

    low, high = np.zeros(len(x), np.int64), most.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = (h[x + mid] - h[x]) * inverse[x] == (h[y + mid] - h[y]) * inverse[y]
        low, high = np.where(same & open_, mid, low), np.where(same | ~open_, high, mid - 1)


def sort_suffixes(data, h, inverse, start, room, group):
    """Order of the suffixes (start, room bytes) within their groups (sorted ids), and each one's extension with the one before.

    Bottom-up mergesort over all groups at once: a suffix's place in a merged run is its place in its own run plus the
    number of suffixes of the other run before it, found by binary search.
    """
    import numpy as np

    n = len(start)
    order = np.arange(n)
    begin = np.searchsorted(group, group, "left")
    end = np.searchsorted(group, group, "right")

    def before(i, j, ties):
        """Whether suffix j comes before suffix i; ties tells what equal ones count as."""
        both = np.minimum(room[i], room[j])
        same = extension(h, inverse, start[i], start[j], both)
        byte = lambda k: np.where(same < room[k], data[np.minimum(start[k] + same, len(data) - 1)].astype(np.int16), -1)
        bi, bj = byte(i), byte(j)
        return np.where(bi == bj, ties, bj < bi)

    wide = 1
    while n and wide < int((end - begin).max()):
        slot = np.arange(n)
        rel = slot - begin
        left = rel // wide % 2 == 0
        run = begin + rel // wide * wide  # where the own run begins
        other = np.where(left, run + wide, run - wide)
        other_end = np.minimum(other + wide, end)
        active = np.flatnonzero((other < other_end) & (other >= begin))
        low, high, base = other[active].copy(), other_end[active].copy(), other[active]
        mine, is_right = order[active], ~left[active]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            less = before(mine[open_], order[mid], is_right[open_])
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        place = slot.copy()
        place[active] = np.minimum(run[active], base) + (slot[active] - run[active]) + (low - base)
        new = order.copy()
        new[place] = order
        order = new
        wide *= 2
    prior = np.full(n, -1, np.int64)
    k = np.flatnonzero(group[1:] == group[:-1]) + 1 if n else np.zeros(0, np.int64)
    a, b = order[k - 1], order[k]
    prior[k] = extension(h, inverse, start[a], start[b], np.minimum(room[a], room[b]))
    return _verified(data, start, room, group, order, prior)


def _verified(data, start, room, group, order, prior):
    """Checks neighbours by their bytes; groups in which a hash lied are sorted by bytes."""
    import numpy as np

    raw = data.tobytes()
    wrong = set()
    s, r = start.tolist(), room.tolist()
    for k, (i, same) in enumerate(zip(order.tolist(), prior.tolist(), strict=True)):
        if same >= 0:
            j = before
            x, y = raw[s[j] : s[j] + r[j]], raw[s[i] : s[i] + r[i]]
            if x[:same] != y[:same] or not (x[same : same + 1] <= y[same : same + 1]) or (x[same : same + 1] == y[same : same + 1] != b""):
                wrong.add(int(group[k]))
        before = i
    for g in wrong:
        a, b = np.searchsorted(group, [g, g + 1])
        own = sorted(order[a:b].tolist(), key=lambda i: raw[s[i] : s[i] + r[i]])
        order[a:b] = own
        for k in range(a + 1, b):
            x, y = (raw[s[i] : s[i] + r[i]] for i in (order[k - 1], order[k]))
            prior[k] = next((t for t in range(min(len(x), len(y))) if x[t] != y[t]), min(len(x), len(y)))
    return order, prior


def repeated_windows(contents: list[bytes], anchors, windows, group):
    """Matrix (segment, offset of the anchor in the window): whether another segment of the group holds the same window."""
    import numpy as np

    joined = b"".join(contents)
    sizes = np.array([len(c) for c in contents], np.int64)
    begin = np.cumsum(sizes) - sizes
    n = len(contents)
    tables = _tables(len(joined))

    def ordered(raw, start, room):
        data = np.frombuffer(raw, np.uint8)
        order, prior = sort_suffixes(data, prefix_hashes(data, tables), tables[2], start, room, group)
        return order, prior

    right = ordered(joined, begin + anchors, np.minimum(sizes - anchors, LENGTH))
    mirrored = joined[::-1]
    left = ordered(mirrored, len(joined) - (begin + anchors), anchors)
    out = np.zeros((n, WIDE), bool)
    classes = lambda o, least: _spread(o[0], np.cumsum(o[1] < least))
    for offset in range(WIDE):
        own = np.flatnonzero((offset <= anchors) & (offset >= anchors - (windows - 1)))
        if len(own) < 2:
            continue
        key = classes(right, LENGTH - offset)[own] * np.int64(n + 1) + classes(left, offset)[own]
        _, at, times = np.unique(key, return_inverse=True, return_counts=True)
        out[own, offset] = times[at] > 1
    return out


def _spread(order, values):
    import numpy as np

    out = np.empty(len(order), np.int64)
    out[order] = values
    return out


def _solve(batches):
    """FETCHED rows sorted by g to spans (doc, a, b) of bytes that repeat; for segments that stand there once."""
    import numpy as np
    import pyarrow as pa

    def solved(g, n, doc, place, content):
        order = np.argsort(g, kind="stable")
        g, n, doc, place = (x[order] for x in (g, n, doc, place))
        content = [content[i] for i in order]
        group = np.cumsum(np.r_[0, g[1:] != g[:-1]])
        anchors, windows, first = place & 255, (place >> 8 & 255) + 1, place >> 16
        hit = repeated_windows(content, anchors, windows, group)
        hit[n > 1] = False
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)  # offsets a..b-1; the window of offset o starts at anchor - o
        at = first[row] + anchors[row]
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(at - (b - 1)), pa.array(at - a + LENGTH)], ["doc", "a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append([*(np.array(batch.column(k), np.int64) for k in range(4)), batch.column(4).to_pylist()])
        rows += batch.num_rows
        if rows >= STEP_ROWS:
            g, n, doc, place = (np.concatenate([h[k] for h in held]) for k in range(4))
            content = [c for h in held for c in h[4]]
            cut = int(np.flatnonzero(g != g[-1])[-1]) + 1 if (g != g[-1]).any() else 0
            if cut:
                yield solved(g[:cut], n[:cut], doc[:cut], place[:cut], content[:cut])
            held, rows = [[g[cut:], n[cut:], doc[cut:], place[cut:], content[cut:]]], len(g) - cut
    if rows:
        g, n, doc, place = (np.concatenate([h[k] for h in held]) for k in range(4))
        yield solved(g, n, doc, place, [c for h in held for c in h[4]])


def _blocks(batches):
    """FETCHED rows to blocks of at most BLOCK windows: (core, b1, b2, doc, a, windows, content).

    core: hash of the bytes that all windows of the block hold; b1, b2: 128-bit hash of all its bytes.
    """
    import pyarrow as pa
    from xxhash import xxh3_64_intdigest, xxh3_128_digest

    for batch in batches:
        out = []
        for g, _, doc, place, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, windows, anchor = place >> 16, (place >> 8 & 255) + 1, place & 255
            for block in range((anchor - windows + 1) // BLOCK, anchor // BLOCK + 1):  # by the anchor's offset in the window
                a = max(0, anchor - (block * BLOCK + BLOCK - 1))
                b = min(windows - 1, anchor - block * BLOCK)
                # [low, high) lies in every window of the block, and so in the content
                low, high = anchor - block * BLOCK, anchor - (block * BLOCK + BLOCK - 1) + LENGTH
                core, body = xxh3_64_intdigest(content[low:high], (g ^ block) & 0xFFFFFFFF), content[a : b + LENGTH]
                d = xxh3_128_digest(body, anchor - a)
                out.append((core - (core >> 63 << 64), signed(d[:8]), signed(d[8:]), doc, first + a, b - a + 1, body))
        kinds = (pa.int64(),) * 6 + (pa.binary(),)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, kinds, strict=True)], ["core", "b1", "b2", "doc", "a", "windows", "content"])


def signed(raw: bytes) -> int:
    return int.from_bytes(raw, "little", signed=True)


def _windows(batches):
    """(doc, a, windows, n, content) to each window's 128-bit hash: (h1, h2, doc, a, n)."""
    import pyarrow as pa
    from xxhash import xxh3_128_digest

    for batch in batches:
        out = []
        for doc, a, windows, n, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for k in range(windows):
                d = xxh3_128_digest(content[k : k + LENGTH])
                out.append((signed(d[:8]), signed(d[8:]), doc, a + k, n))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)], ["h1", "h2", "doc", "a", "n"])


def spans(docs: DataFrame) -> DataFrame:
    """docs (doc: a key of its own, text) to spans (doc, a, b) whose bytes go; spans may overlap."""
    segments = stored(docs.mapInArrow(_segments, SEGMENT), "segments")
    grams = segments.groupBy("g").agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).filter("n > 1")
    grams = stored(grams.select("g", "n", (F.col("low") == F.col("high")).alias("one_kind")), "grams")
    hits = stored(salted_join(segments, grams, ["g"], "n").drop("n"), "hits")
    discard(segments, grams)
    whole = lambda df: df.select("doc", F.shiftright("place", 16).alias("a"), (F.shiftright("place", 16) + F.expr("(shiftright(place, 8) & 255)") + LENGTH).alias("b"))
    mixed = hits.filter("not one_kind")
    kinds = stored(mixed.groupBy("g", "s").agg(F.count("*").alias("n"), F.first("doc").alias("doc"), F.first("place").alias("place")), "kinds")
    crowded = stored(kinds.groupBy("g").count().filter(F.col("count") > HOT).select("g"), "crowded")
    wanted = kinds.groupBy("doc").agg(F.collect_list(F.struct("g", "n", "place")).alias("w"))
    texts = docs.join(wanted, "doc").select("doc", "text", F.col("w.g").alias("gs"), F.col("w.n").alias("ns"), F.col("w.place").alias("places"))
    fetched = stored(texts.mapInArrow(_fetch, FETCHED), "fetched")
    cold = fetched.join(crowded, "g", "left_anti").repartition("g").sortWithinPartitions("g").mapInArrow(_solve, "doc long, a long, b long")
    out = [whole(hits.filter("one_kind")), whole(salted_join(mixed, kinds.filter("n > 1").select("g", "s", "n"), ["g", "s"], "n", "left_semi")), cold]
    if crowded.limit(1).count():
        kind = "core long, b1 long, b2 long, doc long, a long, windows long, content binary"
        blocks = stored(fetched.join(crowded, "g", "left_semi").select(*[x.split()[0] for x in FETCHED.split(", ")]).mapInArrow(_blocks, kind), "blocks")
        # blocks with the same bytes are one kind again; only different kinds that share a core are compared by windows
        same = blocks.groupBy("core", "b1", "b2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "a")).alias("one"))
        same = stored(same.select("core", "b1", "b2", "n", F.col("one.doc").alias("doc"), F.col("one.a").alias("a")), "block-kinds")
        equal = blocks.join(same.filter("n > 1").select("b1", "b2"), ["b1", "b2"], "left_semi")
        out.append(equal.select("doc", "a", (F.col("a") + F.col("windows") - 1 + LENGTH).alias("b")))
        shared = same.groupBy("core").count().filter("count > 1").select("core")
        ones = same.join(shared, "core", "left_semi").select("b1", "b2", "doc", "a", "n")
        found = blocks.join(ones, ["b1", "b2", "doc", "a"]).select("doc", "a", "windows", "n", "content").mapInArrow(_windows, "h1 long, h2 long, doc long, a long, n long")
        found = stored(found, "windows")
        again = stored(found.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "again")
        again = found.filter("n = 1").join(again, ["h1", "h2"], "left_semi")
        out.append(again.select("doc", "a", (F.col("a") + LENGTH).alias("b")))
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return spans


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_out(with_text: bool):
    def cut_out(batches):
        """(doc_id, text, starts, ends) to what is left."""
        import hashlib

        import numpy as np
        import pyarrow as pa

        names = [x.split()[0] for x in CUT.split(", ")] + ["kept"] * with_text
        for batch in batches:
            data, ends = arrow_texts(batch.column(1))
            out = []
            for doc, a, b, starts, stops in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.array(starts or [], np.int64), np.array(stops or [], np.int64)
                order = np.argsort(x, kind="stable")
                x, y = x[order], np.maximum.accumulate(y[order]) if len(y) else y
                new = np.flatnonzero(np.r_[True, x[1:] > y[:-1]]) if len(x) else order
                x, y = x[new].tolist(), (y[np.r_[new[1:], len(y)] - 1].tolist() if len(x) else [])
                kept = b"".join(data[a + p : a + q] for p, q in zip([0, *y], [*x, b - a], strict=True))
                row = (doc, b - a, b - a - len(kept), len(x), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_text else row)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(kinds), kinds, strict=True)], names)

    return cut_out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ids = slim.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
    if len(set(ids)) == 1:
        keyed = slim.withColumn("doc", F.col("doc_id"))
    else:  # a key for each row needs rows that stay as they are
        keyed = stored(slim.withColumn("doc", F.monotonically_increasing_id()), "rows")
    found = spans(keyed.select("doc", "text"))
    found = stored(found.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("s")), "spans")
    rows = keyed.join(found, "doc", "left").select("doc_id", "text", F.col("s.a").alias("starts"), F.col("s.b").alias("stops"))
    return rows.mapInArrow(_cut_out(with_text), CUT + ", kept binary" * with_text)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
