import random

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import near_text as M
from tests.llm.fixtures import documents, odd_rows, text
from tests.llm.test_simhash import slow_print


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def groups(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def copies_with_edits(rng):
    """Texts, copies with a word in 80 changed, chains of such copies, and half-alike texts."""
    out = []
    for _ in range(12):
        base = text(rng, rng.choice([60, 150, 400])).split()
        out.append(" ".join(base))
        for rate in (0.012, 0.012, 0.08):
            out.append(" ".join(w if rng.random() > rate else f"new{rng.randrange(9**6)}" for w in base))
    for _ in range(4):
        out.append(" ".join(w if rng.random() > 0.01 else f"more{rng.randrange(9**6)}" for w in out[1].split()))
    return out


@pytest.mark.parametrize("hot", [2048, 3])
def test_pairs_equal_brute_force(spark, monkeypatch, hot):
    rng = random.Random(5)
    texts = copies_with_edits(rng)
    monkeypatch.setattr(M, "CHUNK", 4 if hot == 3 else 2048)
    monkeypatch.setattr(M, "PAIRS_OF_ONE", 2 if hot == 3 else 4096)
    edges = M.similar(spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3), hot=hot).collect()
    assert all(alike(texts[r.a], texts[r.b]) >= 0.8 for r in edges)
    want = groups(len(texts), lambda i, j: alike(texts[i], texts[j]) >= 0.8)
    have = {(r.a, r.b) for r in edges} | {(r.b, r.a) for r in edges}
    assert groups(len(texts), lambda i, j: (i, j) in have) == want and len(set(want)) < len(texts)


def test_one_of_each_group_stays(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    prints = [slow_print(r[1]) for r in rows]
    root = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2 or alike(rows[i][1], rows[j][1]) >= 0.8)
    left = M.drop_near_copies(docs)
    assert left.columns == docs.columns
    first = {}
    for k, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        first[root[k]] = min(key, first.get(root[k], key))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == sorted(first.values())


def test_unique_ids_and_empty_table(spark):
    rows = [r for r in {r[0]: r for r in odd_rows() if r[0] is not None}.values()]
    left = {r.doc_id for r in M.drop_near_copies(documents(spark, rows)).collect()}
    assert 900 in left and 902 not in left and 920 not in left
    assert M.drop_near_copies(documents(spark, [])).count() == 0


def test_large_group_yields_one_edge_a_document(spark):
    rng = random.Random(2)
    base = text(rng, 300).split()
    texts = [" ".join(w if rng.random() > 0.01 else f"x{rng.randrange(9**6)}" for w in base) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    edges = M.similar(df).withColumn("n", F.lit(1)).collect()
    have = {(r.a, r.b) for r in edges} | {(r.b, r.a) for r in edges}
    want = groups(150, lambda i, j: alike(texts[i], texts[j]) >= 0.8)
    assert groups(150, lambda i, j: (i, j) in have) == want and want.count(0) > 100
    assert len(edges) < 32 * 150 < sum(alike(texts[i], texts[j]) >= 0.8 for i in range(150) for j in range(i))


def grouped(spark, texts, **more):
    edges = M.similar(spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3), **more).collect()
    assert all(alike(texts[r.a], texts[r.b]) >= 0.8 for r in edges)
    have = {(r.a, r.b) for r in edges} | {(r.b, r.a) for r in edges}
    return groups(len(texts), lambda i, j: (i, j) in have)


def test_appended_and_truncated_copies(spark):
    rng, texts = random.Random(11), []
    for n, more in [(100, 24), (100, 20), (300, 60), (300, 45), (300, 30), (10, 1)] * 4:
        words = [f"w{rng.randrange(10**6)}" for _ in range(n + more)]
        texts += [" ".join(words[:n]), " ".join(words)] if rng.random() < 0.5 else [" ".join(words), " ".join(words[more:])]
    pairs = [alike(texts[k], texts[k + 1]) for k in range(0, len(texts), 2)]
    assert min(pairs) >= 0.79 and sum(0.8 <= p <= 0.91 for p in pairs) >= 20
    assert grouped(spark, texts) == groups(len(texts), lambda i, j: alike(texts[i], texts[j]) >= 0.8)


def test_a_chain_holds_in_a_crowded_key(spark, monkeypatch):
    """Neighbours of the chain are alike, others aren't; all share the words in the middle, more than a chunk holds."""
    monkeypatch.setattr(M, "CHUNK", 4)
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(words[k * 25 : k * 25 + 300]) for k in range(13)]
    order = list(range(13))
    rng.shuffle(order)
    texts = [texts[k] for k in order]
    assert alike(*(texts[order.index(k)] for k in (0, 2))) < 0.8
    assert grouped(spark, texts, hot=2) == [0] * 13


def test_a_crowd_does_not_part_a_pair(spark):
    """The pairs that a small table links are linked among many others that share most of their words."""
    rng = random.Random(17)
    shared = [f"w{rng.randrange(10**6)}" for _ in range(240)]
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    pairs = []
    for _ in range(12):
        own = shared + fresh(60)
        pairs += [" ".join(own), " ".join(own + fresh(rng.choice([45, 60, 70])))]
    crowd = [" ".join(shared + fresh(rng.choice([70, 90]))) for _ in range(60)]
    small = grouped(spark, pairs)
    want = groups(len(pairs + crowd), lambda i, j: alike((pairs + crowd)[i], (pairs + crowd)[j]) >= 0.8)
    assert small == want[:24] and small == [k - k % 2 for k in range(24)]
    assert grouped(spark, pairs + crowd, hot=8) == want


def test_equal_words_in_other_orders(spark):
    """Texts over the same words: alike ones are linked past reorderings of them, and so are texts near any of them."""
    rng, texts = random.Random(23), []
    for _ in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        other = rng.sample(words, 200)
        a, b = " ".join(words), " ".join(other)
        c = " ".join(words[:190] + words[190:][::-1])  # alike a, of the same words
        d = " ".join([*other, "tail"])  # near b, not near a
        texts += [a, b, c, d]
    assert grouped(spark, texts) == [k // 4 * 4 + k % 2 for k in range(16)]
