import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import winnow as M
from tests.llm.fixtures import documents, odd_rows, text

P = M.PRIME


def brute(t):
    """The selected (position, hash) pairs, by looking at every window."""
    units = [w[i : i + M.PIECE] for w in split(t) for i in range(0, len(w), M.PIECE)]
    codes = [xx(u) % P for u in units]
    h = []
    for i in range(max(1, len(codes) - M.GRAM + 1) if codes else 0):
        x = 0
        for c in codes[i : i + M.GRAM]:
            x = (x * M.BASE + c) % P
        h.append(x)
    picked = {}
    for i in range(max(1, len(h) - M.WINDOW + 1) if h else 0):
        part = h[i : i + M.WINDOW]
        low = min(part)
        at = max(k for k in range(len(part)) if part[k] == low) + i
        picked[at] = low
    return sorted(picked.items())


def jaccard(a, b):
    x, y = ({h for _, h in p} for p in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def split(t):
    import re

    return re.findall(r"[^\x20\x09-\x0d]+", t)


def xx(s):
    from xxhash import xxh64_intdigest

    n = xxh64_intdigest(s.encode(), 42)
    return n - (n >> 63 << 64)


def test_equals_brute_force(spark):
    rows = odd_rows()
    ordered = sorted(((d if d is not None else -1, t or "") for d, t, *_ in rows), key=lambda x: (x[0], xx(x[1])))
    want = []
    for (d, t), (_, after) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        cut = len(t) // 2
        edited = t[: len(t) - cut] + after[:cut]
        a, b, c = brute(t), brute(edited), brute(after)
        show = lambda p: " ".join(f"{h:x}@{k}" for k, h in p)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), round(jaccard(a, b), 9), round(jaccard(a, c), 9)))
    got = M.fingerprints(documents(spark, rows).repartition(4)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)


def test_one_more_character_keeps_fingerprints_alike(spark):
    t = text(random.Random(5), 80)
    rows = [(k, t[: 480 + k], "en", "a", 1) for k in range(40)]
    near = [r.near_next for r in M.fingerprints(documents(spark, rows)).collect() if r.doc_id < 39]
    assert min(near) > 0.9


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_next_document(spark, buckets):
    rng = random.Random(buckets)
    ids = [None, *rng.sample(range(-500, 10_000), 80), 7777, 7777]
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string").withColumn("__tie", F.xxhash64("text"))
    got = M.with_next(docs, ["text"], buckets).collect()
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r["__tie"]))
    assert [r.next_text for r in order] == [*[r.text for r in order[1:]], order[0].text] and len(got) == len(ids)


def test_long_match_is_found(spark):
    rng = random.Random(2)
    shared = text(rng, M.GRAM + M.WINDOW - 1 + 2)
    a, b = (text(rng, 90) + " " + shared + " " + text(rng, 90) for _ in range(2))
    p = [[x >> 31 for x in r[0]] for r in spark.createDataFrame([(a,), (b,)], "text string").select(M.winnow(F.col("text"))).collect()]
    assert set(p[0]) & set(p[1])


def test_one_and_no_document(spark):
    assert M.fingerprints(documents(spark, [])).count() == 0
    r = M.fingerprints(documents(spark, [(1, "some words are here", "en", "a", 1)])).first()
    assert r.near_next == 1.0
    both = M.fingerprints(documents(spark, [(1, None, "en", "a", 1), (2, "", "en", "a", 1)])).collect()
    assert [(x.fingerprint, x.near_edited, x.near_next, x.n_chars) for x in both] == [("", 1.0, 1.0, 0)] * 2
