import random

import numpy as np
from xxhash import xxh64_intdigest

from lexiforge.llm import simhash as M
from tests.llm.fixtures import documents, odd_rows


def slow_print(t):
    words = [w for w in (t or "").encode().lower().split()]
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(values, budget=2):
    """value -> smallest value reachable."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= budget:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def near_values(rng, n):
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.add(base)
            for _ in range(rng.randint(1, 3)):
                base ^= 1 << rng.randrange(64)
    return sorted(out)


def test_trie_pairs_equal_brute_force():
    rng = random.Random(4)
    values = np.array(near_values(rng, 400), np.uint64)
    for frontier in (64, 500_000):
        got = sorted((int(min(i, j)), int(max(i, j))) for a, b in M.trie_pairs(np.zeros(len(values), np.int64), values, frontier=frontier) for i, j in zip(a, b, strict=True))
        want = [(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= 2]
        assert got == want and want


def test_links_and_components_lose_nothing(spark):
    rng = random.Random(9)
    values = near_values(rng, 700) + [0, 1, 3, 7, 15, 31, 63]
    want = slow_components(values)
    signed = lambda x: x - (x >> 63 << 64)
    df = spark.createDataFrame([(signed(v),) for v in set(values)], "print long").repartition(5)
    for hot in (M.HOT, 3):
        found = {r.node % (1 << 64): r.root % (1 << 64) for r in M.components(M.links(df, hot)).collect()}
        groups = {}
        for v in set(values):
            groups.setdefault(found.get(v, v), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(v for v in want if want[v] == r) for r in set(want.values()))


def test_near_copies_equal_brute_force(spark):
    rows = odd_rows()
    prints = [slow_print(t) for _, t, *_ in rows]
    root = slow_components(prints)
    least = {}
    for (d, *_), p in zip(rows, prints, strict=True):
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in x)
    want = sorted(((d, f"{p:016x}", least.get(root[p])) for (d, *_), p in zip(rows, prints, strict=True)), key=key)
    got = M.near_copies(documents(spark, rows).repartition(3)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == want


def test_empty_table(spark):
    assert M.near_copies(documents(spark, [])).count() == 0
    one = M.near_copies(documents(spark, [(5, None, None, None, None), (4, "", None, None, None)])).collect()
    assert [(r.fingerprint, r.component_id) for r in one] == [("0" * 16, 4)] * 2
