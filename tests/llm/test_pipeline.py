"""The pipeline's stages, each on its own input, and the whole."""

import random
import re
import zlib
from collections import Counter

import corpus_pipeline as P
from lexiforge.llm._shared import read_table
from tests.llm.fixtures import documents
from tests.llm.test_exact_dedup import normal
from tests.llm.test_mixing import brute_copies
from tests.llm.test_near_text import groups, shingle_set
from tests.llm.test_packing import check_round_trip
from tests.llm.test_quality import labelled, plain_scores, plain_statistics
from tests.llm.test_simhash import slow_print


def test_stages_on_odd_rows(spark, sf_dir):
    docs = documents(spark)
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns or name == "packing"
        assert stage(spark, documents(spark, []), sf_dir).count() == 0
        assert out.count() > 0


def test_run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    kept = docs
    for _, stage in P.STAGES[:3]:
        kept = stage(spark, kept, sf_dir).cache()
    texts = [re.sub(r"\s+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts))
    mixed = Counter(r.doc_id for r in P.mixing(spark, kept, sf_dir).collect())
    assert max(mixed.values()) <= 3
    pieces = P.run(spark, sf_dir).collect()
    got = Counter(r.doc_id for r in pieces if r.start == 0)
    assert got == mixed


def test_run_equals_plain_stages(spark, tmp_path):
    """run() over a table with bad documents, exact, appended, truncated and edited copies, against every stage in plain Python."""
    rng = random.Random(12)
    rows, labels = labelled()
    rows, labels = rows[:260], labels[:260]
    base = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(rng.choice([40, 120, 260]))) for _ in range(8)]
    more = []
    for t in base:
        words = t.split()
        cut, own = len(words) // 8, [f"n{rng.randrange(10**6)}" for _ in range(len(words) // 7)]
        more += [t, t.replace(" ", "\n", 3), " ".join(words + own), " ".join(words[cut:]), " ".join([*words[:9], "edit", *words[10:]]), " ".join(words[: len(words) // 2])]
    more += [None, "", "x", "short one here", "short  one here"]
    rows += [(1000 + k, t, "en", "abc"[k % 3], 1) for k, t in enumerate(more)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    train = [(plain_statistics(rows[d][1]), q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 4 != 2]
    scores = plain_scores(*zip(*train, strict=True), [plain_statistics(r[1]) for r in rows])
    assert min(abs(s - 0.7) for s in scores) > 1e-4
    kept = [r for r, s in zip(rows, scores, strict=True) if s >= 0.7]
    assert len(kept) < len(rows)
    first = {}
    for r in sorted(kept, key=lambda r: r[0]):
        first.setdefault(normal(r[1]), r)
    unique = list(first.values())
    assert len(unique) < len(kept)
    prints, sets = [slow_print(r[1]) for r in unique], [shingle_set(r[1]) for r in unique]
    like = lambda a, b: len(a & b) >= 0.8 * len(a | b) if a or b else True
    root = groups(len(unique), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2 or like(sets[i], sets[j]))
    single = [r for k, r in enumerate(unique) if root[k] == k]
    assert len(single) < len(unique)
    copies = brute_copies(spark, spark.createDataFrame(single, kind), single)
    mixed = [r for r in single for _ in range(copies[r[0]])]
    assert check_round_trip(mixed, P.run(spark, str(tmp_path)).collect())


def test_good_documents_stay(spark, sf_dir):
    labels = {r.doc_id for r in read_table(spark, sf_dir, "labels").filter("quality = 1").collect()}
    left = {r.doc_id for r in P.quality(spark, read_table(spark, sf_dir, "documents"), sf_dir).collect()}
    assert len(labels - left) <= 0.03 * len(labels)
