import hashlib
import re

from lexiforge.llm.exact_dedup import copies, drop_copies, op6_exact_dedup
from lexiforge.llm.registry import oracle_sql
from tests.compare import check, connect
from tests.llm.fixtures import documents, odd_rows


def normal(t):
    return re.sub(r"[ \t\n\v\f\r]+", " ", t or "")


def test_equals_brute_force(spark):
    rows = odd_rows()
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(normal(t), []).append(d)
    first = {t: min(ids, key=lambda d: (d is None, d or 0)) for t, ids in groups.items()}
    want = sorted(((d is None, d or 0), -1 if first[normal(t)] is None else first[normal(t)], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for d, t, *_ in rows)
    for parts, fan in ((1, 8), (7, 2)):
        got = copies(documents(spark, rows).repartition(parts), fan_in=fan).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), -1 if r.keep_id is None else r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.kept <= (r.doc_id == r.keep_id) for r in got)


def test_drop_copies_keeps_one_row_of_each_group(spark):
    docs = documents(spark)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    texts = [normal(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({normal(r[1]) for r in odd_rows()})


def test_columns_of_any_name_and_reruns(spark):
    rows = [(1, "a b", "p"), (1, "a  b", "q"), (1, "a b", "q"), (2, "a b", "r"), (3, "c", "s"), (None, "c", "t")]
    docs = spark.createDataFrame([(*r, k, "x", None) for k, r in enumerate(rows)], "doc_id long, text string, source string, __text int, __id string, norm int")
    for parts in (1, 5):
        left = drop_copies(docs.repartition(parts, "source"))
        assert left.columns == docs.columns
        assert sorted(tuple(r) for r in left.collect()) == [(1, "a  b", "q", 1, "x", None), (3, "c", "s", 4, "x", None)]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert copies(docs).count() == 0 and drop_copies(docs).count() == 0


def test_sql(spark, sf_dir):
    check(op6_exact_dedup(spark, sf_dir), connect(sf_dir), oracle_sql()["op6_exact_dedup"])
