import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lexiforge.llm import suffix_dedup as M
from tests.llm.fixtures import documents, odd_rows, text


def slow(rows):
    raw = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((d is None, d or 0, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def hot_rows():
    """A line and a passage that many documents share, between texts of their own."""
    rng = random.Random(11)
    line, passage, tail = text(rng, 12)[:100], text(rng, 60), text(rng, 25)
    rows = [(k, f"{text(rng, 30)}\n{line}\n{text(rng, 5)}{passage if k % 2 else ''}{text(rng, 30)}", "en", "a", 1) for k in range(50)]
    return rows + [(100 + k, f"q{k}" + tail + passage[:150] + tail, "en", "a", 1) for k in range(6)] + [(200, rows[0][1][:400], "en", "a", 1)]


@pytest.mark.parametrize("hot", [256, 2])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(M, "HOT", hot)
    for rows in (hot_rows(), [r for r in odd_rows() if r[0] not in (900, 901, 902)]):
        assert got(M.remove_repeats(documents(spark, rows).repartition(4))) == slow(rows)


def test_keys_that_are_spread(spark, monkeypatch):
    from lexiforge.llm import _shared

    monkeypatch.setattr(_shared, "SPREAD", 3)
    rows = hot_rows() + [(300 + k, "ab" * 150 + f" end {k}", "en", "a", 1) for k in range(20)]
    assert got(M.remove_repeats(documents(spark, rows).repartition(4))) == slow(rows)


def test_long_documents_cross_slices(spark, monkeypatch):
    rng = random.Random(3)
    part = text(rng, 300)
    rows = [(1, text(rng, 1500) + part + text(rng, 1500), "en", "a", 1), (2, text(rng, 700) + part, "en", "a", 1), (3, "ab" * 4000, "en", "a", 1)]
    monkeypatch.setattr(M, "SLICE", 3000)
    parts = [b for b in M._segments(iter([batch(rows)]))]
    assert sum(((b.column(3).to_numpy() >> 8 & 255) + 1).sum() for b in parts) == sum(max(0, len(t.encode()) - 199) for _, t, *_ in rows)
    monkeypatch.undo()
    assert got(M.remove_repeats(documents(spark, rows))) == slow(rows)


def batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["doc", "text"])


def test_suffix_sort_and_collisions(monkeypatch):
    rng = random.Random(8)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    raw = b"".join(words)
    size = np.array([len(w) for w in words])
    begin = np.cumsum(size) - size
    group = np.sort(np.array([rng.randrange(9) for _ in words]))
    data, tables = np.frombuffer(raw, np.uint8), M._tables(len(raw))
    for hashes in (M.prefix_hashes(data, tables), np.zeros(len(raw) + 1, np.uint64)):  # the second: every comparison collides
        order, prior = M.sort_suffixes(data, hashes, tables[2], begin, size, group)
        for g in range(9):
            at = np.flatnonzero(group == g)
            own = [words[i] for i in order[at]]
            assert own == sorted(words[i] for i in at) and prior[at[0]] == -1
            for k in range(1, len(own)):
                n = next((i for i, (x, y) in enumerate(zip(own[k - 1], own[k], strict=False)) if x != y), min(len(own[k - 1]), len(own[k])))
                assert prior[at[k]] == n


def test_kept_text_and_empty_table(spark):
    rows = M.remove_repeats(documents(spark, hot_rows()), with_text=True).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)
    assert M.remove_repeats(documents(spark, [])).count() == 0
    assert got(M.remove_repeats(documents(spark, [(1, None, "", "", 0), (2, "x" * 199, "", "", 0)]))) == slow([(1, None), (2, "x" * 199)])
