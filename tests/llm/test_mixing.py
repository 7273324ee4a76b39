import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import mixing as M
from lexiforge.llm.mixing import MOST, mix, op3_mixing, take_mix, word_count
from tests.llm.fixtures import documents, odd_rows, text


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))


def wanted(sizes):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > MOST * sizes[s]]
        if not over:
            return full | share
        full |= {s: MOST * sizes[s] for s in over}


def test_targets_and_copies(spark):
    rng = random.Random(1)
    rows = [(k, text(rng, rng.choice([1, 3, 10, 40, 200])), "en", rng.choice("aaaaaaaabbcd") if k % 13 else None, 1) for k in range(600)]
    rows += odd_rows()
    got = mix(documents(spark, rows).repartition(5)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size(t)) for d, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    taken = Counter()
    want = wanted(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= MOST * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 12), (s, taken[s], want[s])
    again = mix(documents(spark, rows).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_take_mix_repeats_rows(spark):
    docs = documents(spark)
    times = Counter()
    for r in mix(docs).collect():
        times[r.doc_id, r.source, r.size] += r.copies
    left = take_mix(docs)
    assert left.columns == docs.columns
    got = Counter((r.doc_id, r.source, size(r.text)) for r in left.collect())
    assert got == +times


def test_equal_rows_share_their_copies(spark):
    rows = [(7, "one two three", "en", "a", 1)] * 40 + [(None, "four five", "en", "b", 1)] * 50 + [(k, text(random.Random(k), 9), "en", "c", 1) for k in range(30)]
    docs = documents(spark, rows).repartition(7)
    got = mix(docs).collect()
    left = Counter((r.doc_id, r.source) for r in take_mix(docs).collect())
    for key in {(r[0], r[3]) for r in rows}:
        assert left[key] == sum(r.copies for r in got if (r.doc_id, r.source) == key)
    # few of one source, all of another: the equal rows differ by one copy at most
    for source in "ab":
        copies = [r.copies for r in got if r.source == source]
        assert max(copies) - min(copies) <= 1
    assert 0 < sum(r.copies for r in got if r.source == "a") < 80


def solved(spark, rows):
    sized = spark.createDataFrame([(s, size(t)) for _, t, _, s, _ in rows], "source string, size long").filter("size > 0")
    cells = sized.groupBy("source", M._bin(F.col("size")).alias("bin")).agg(F.sum("size").alias("words"))
    state, bands = M.tilts(cells, M.targets(cells))
    return {r.source: r for r in state.collect()}, bands


def test_rates_are_the_optimum(spark):
    """The conditions of the convex problem: source constraints hold, and the bands' gradient vanishes with its ridge."""
    rng = random.Random(4)
    rows = [(k, text(rng, rng.choice([1, 3, 40, 300] if k % 3 else [2, 20, 90])), "en", rng.choice("aaaaaaaabbcd"), 1) for k in range(500)]
    sources, bands = solved(spark, rows)
    total, taken, kept, by = 0, [0.0] * M.BANDS, [0.0] * M.BANDS, Counter()
    for _, t, _, s, _ in rows:
        n = size(t)
        band = min(int(math.log2(n)) // 2, M.BANDS - 1)
        rate = min(3.0, math.exp(sources[s].tilt + bands[band]))
        total, by[s] = total + n, by[s] + n * rate
        taken[band] += n * rate
        kept[band] += n
    for s, r in sources.items():
        assert by[s] == pytest.approx(r.target, rel=1e-6)
    for b in range(M.BANDS):
        assert taken[b] - kept[b] + M.RIDGE * total * bands[b] == pytest.approx(0, abs=1e-5 * total)
    assert max(map(abs, bands)) > 1e-3  # the constraints are coupled: a closed form by source would not do


def brute_copies(spark, docs, rows):
    """Copies by document: rounding by bins from long to short, and by hash inside a bin, in plain Python; doc_ids are unique."""
    sources, bands = solved(spark, rows)
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id", word_count("text")), 1).alias("h")).collect()}
    want = {r[0]: 0 for r in rows}
    for s, of in sources.items():
        bins = {}
        for k, t, _, src, _ in rows:
            n = size(t)
            if src == s and n:
                octave = int(math.log2(n))
                bins.setdefault(n if n < 64 else 64 + 64 * octave + int((n / 2**octave - 1) * 64), []).append((hashes[k], n, k))
        carry = 0.0
        for key in sorted(bins, reverse=True):
            own = sorted(bins[key])
            words = sum(n for _, n, _ in own)
            octave = int(math.log2(key)) if key < 64 else (key - 64) // 64
            rate = min(3.0, math.exp(of.tilt + bands[min(octave // 2, M.BANDS - 1)]))
            far = abs(carry) > M.FAR * of.target
            low, high = (0, 3) if far else (math.floor(rate), min(math.ceil(rate), 3))
            copies = max(low * len(own), min(math.floor((rate * words + carry) / (words / len(own)) + 0.5), high * len(own)))
            carry += rate * words - copies * words / len(own)
            for nth, (_, _, k) in enumerate(own):
                want[k] = copies // len(own) + (nth < copies % len(own))
    return want


def test_copies_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [(k, text(rng, rng.choice([1, 3, 10, 40, 200, 201, 202])), "en", rng.choice("aaaaaaaabbcd") if k % 13 else None, 1) for k in range(500)]
    docs = documents(spark, rows)
    assert {r.doc_id: r.copies for r in mix(docs).collect()} == brute_copies(spark, docs, rows)


def test_empty_and_wordless_tables(spark):
    assert mix(documents(spark, [])).count() == 0 and take_mix(documents(spark, [])).count() == 0
    got = mix(documents(spark, [(1, None, "en", None, 0), (2, " ", "en", "a", 0)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_query(spark, sf_dir):
    rows = op3_mixing(spark, sf_dir).collect()
    by = Counter()
    for r in rows:
        by[r.source, r.target] += r.taken
    assert all(abs(n - t) < 0.05 * t for (_, t), n in by.items())


def test_words_are_counted_without_a_list_of_them(spark):
    texts = [None, "", " ", "\t\n\x0b\x0c\r ", "a", " a", "a ", "\n a\x0b\x0cb\r\n", "\x1f \x1c\x85 \xa0 x", "é 東京 \U0001f600 \x00", "$1 \\ x", "ab " * 200_000, "\r" * 50_000 + "z"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").select("k", word_count("text").alias("n"))
    assert {r.k: r.n for r in docs.collect()} == {k: size(t) for k, t in enumerate(texts)}
    # a list of the words of one text takes many times the text's memory
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "array<" not in plan
