import math
import random
import zlib

import numpy as np
import pytest

from lexiforge.llm import quality as M
from lexiforge.llm._shared import read_table
from tests.llm.fixtures import documents, odd_rows, text


def labelled():
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        good = rng.random() < 0.7
        t = text(rng, rng.choice([5, 40, 150]))
        rows.append((k, t if good else " ".join(w.upper() + "!!" for w in t.split()), "en", "a", 1))
        labels.append((k, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_bounds(spark):
    rows, labels = labelled()
    rows += odd_rows()
    marks = spark.createDataFrame([*labels, (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = M.quality(documents(spark, rows).repartition(3), marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= M.THRESHOLD) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    truth = dict((d, q) for d, q, _ in labels)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth and r.doc_id < 400 and len(rows[r.doc_id][1]) > 40]
    assert np.mean([a == b for a, b in held]) > 0.95
    few = M.quality(documents(spark, rows), marks, train_rows=60).collect()
    assert len(few) == len(rows)


def plain_statistics(t):
    """The statistics of a text from their names, by counting in strings."""
    raw = (t or "").encode()
    words = raw.split()
    n = max(1, len(words))
    count = lambda s: sum(raw.count(bytes([c])) for c in s.encode())
    upper, lower = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    lead = sum(b >= 192 for b in raw)
    marks = sum(33 <= b < 127 and not chr(b).isalnum() for b in raw)
    usual = count("!|#$%&*.,")
    solid = len(raw) - sum(9 <= b <= 13 for b in raw) - raw.count(b" ")
    root = [upper / max(1, upper + lower + lead), count("!") / n, count("#$%&*") / n, count("|") / n, sum(48 <= b <= 57 for b in raw) / max(1, len(raw)), count(".") / n, count(",") / n, count("\n") / n]
    pairs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out = [math.log(1 + len(words)), math.log(1 + solid / n), len(set(words)) / max(1.0, len(words) ** 0.85), *map(math.sqrt, root)]
    return [*out, math.sqrt(pairs / n), math.sqrt((marks - usual) / n), math.sqrt(sum(b >= 128 for b in raw) / max(1, len(raw)))]


def plain_scores(x, y, rows):
    """Quadratic discriminant by explicit inverses and determinants, and a logistic curve by small steps."""
    x, y, rows = np.array(x, np.float32).astype(float), np.array(y), np.array(rows, np.float32).astype(float)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    z, r = (x - mean) / spread, (rows - mean) / spread
    pooled = np.diag((((z[y == 0] - z[y == 0].mean(0)) ** 2).sum(0) + ((z[y == 1] - z[y == 1].mean(0)) ** 2).sum(0)) / len(z)) + 1e-3 * np.eye(z.shape[1])

    def density(train, share, points):
        d = train - train.mean(0)
        cov = (1 - share) * d.T @ d / len(d) + share * pooled
        off = points - train.mean(0)
        return np.array([-0.5 * v @ np.linalg.inv(cov) @ v - 0.5 * np.log(np.linalg.det(cov)) for v in off])

    best = {}
    for c in (0, 1):
        own = z[y == c]
        best[c] = max(M.SHRINKAGES, key=lambda a: density(own[::2], a, own[1::2]).sum() + density(own[1::2], a, own[::2]).sum())  # noqa: B023
    ratio = lambda points: np.arcsinh((density(z[y == 1], best[1], points) - density(z[y == 0], best[0], points)) / 4)
    t, slope, shift = ratio(z), 1.0, 0.0
    for _ in range(200_000):
        p = 1 / (1 + np.exp(-(slope * t + shift)))
        g = t @ (p - y) + 1e-2 * (slope - 1), (p - y).sum() + 1e-2 * shift
        slope, shift = slope - 2e-3 * g[0], shift - 2e-3 * g[1]
        if max(map(abs, g)) < 1e-9:
            break
    return 1 / (1 + np.exp(-(slope * ratio(r) + shift)))


def test_scores_equal_brute_force(spark):
    rows, labels = labelled()
    rng = random.Random(6)
    labels = [(d, q if rng.random() > 0.1 else 1 - q, t) for d, q, t in labels]  # classes that overlap
    more = [r for r in odd_rows() if r[0] is None or r[0] >= 900]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = M.quality(documents(spark, rows + more).repartition(3), marks).collect()
    train = [(plain_statistics(rows[d][1]), q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 4 != 2]
    want = plain_scores(*zip(*train, strict=True), [plain_statistics(r[1]) for r in rows + more])
    have = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in got)
    wanted = sorted((r[0] is None, r[0] or 0, s) for r, s in zip(rows + more, want, strict=True))
    assert [x[:2] for x in have] == [x[:2] for x in wanted]
    assert np.abs(np.array([x[2] for x in have]) - [x[2] for x in wanted]).max() < 1e-4


def test_labels_of_the_held_out_quarter_change_nothing(spark):
    rows, labels = labelled()
    docs = documents(spark, rows)
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 4 == 2 else q, t) for d, q, t in labels]
    one, two = ({r.doc_id: r.score for r in M.quality(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, flipped))
    assert one == two


@pytest.mark.parametrize(("marks", "score"), [([], 0.5), ([(1, 1, 0), (3, 1, 0)], 1.0)])
def test_without_two_classes(spark, marks, score):
    got = M.quality(documents(spark, [(1, "a b", "", "", 0), (3, None, "", "", 0)]), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert [r.score for r in got] == [score] * 2


def test_empty_table_and_filter(spark):
    rows, labels = labelled()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert M.quality(documents(spark, []), marks).count() == 0
    docs = documents(spark, rows)
    left = M.keep_good(docs, marks)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in M.quality(docs, marks).filter("predicted = 1").collect()}


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in M.op8_quality(spark, sf_dir).collect()}
    truth = {r.doc_id: r.quality for r in read_table(spark, sf_dir, "labels").collect()}
    held = [got[d].predicted == q for d, q in truth.items() if got[d].held_out]
    assert np.mean(held) > 0.85
