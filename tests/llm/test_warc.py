import hashlib
import io
import random

import pytest

from lexiforge.llm import warc as M
from lexiforge.llm.registry import oracle_sql
from tests.compare import check, connect


def pages():
    big, other = "<p>é" + "x" * 1000, "y" * 1000
    rows = [(k, f"http://www.Site{k % 3}.org/p{k % 5}?q#f", big if k % 3 == 0 else other + str(k), "f", 1) for k in range(40)]
    rows += [(50, None, None, "f", 1), (51, "http://e.org/", "", "f", 1), (52, "bad\r\nurl: x", "small", "f", 1), (53, "http://e.org/", "small", "f", 1), (None, "http://n.org/", big, "f", 1), (54, "x://y", "WARC/1.1\r\n\r\n" * 200, "f", 1), (55, "x://y", "WARC/1.1\r\n\r\n" * 200, "f", 1)]
    return [*rows, (60, "http://long.org/", "z" * 2_000_000, "f", 1), (3, "http://www.Site0.org/p3", big, "f", 1)]


@pytest.mark.parametrize("limits", [{"FILE_RECORDS": 7}, {"FILE_RECORDS": 5, "FAN_IN": 3, "BLOCK_ROWS": 2, "PART_ROWS": 6}])
def test_round_trip(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(M, name, value)
    rows = pages()
    df = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], "page_id long, url string, html string, file string, length int, part string, run int, digest string").repartition(4)
    got = M.archive(df).collect()
    assert len(got) == len(rows)
    groups = {}
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            groups[raw] = max(page, groups.get(raw, page))
    key = lambda x: tuple((v is None, v if v is not None else 0) for v in x)
    want = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        last = groups.get(raw)
        revisit = last is not None and page != last
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    order = [(r.url_key, r.stamp, r.page_id is None, r.page_id or 0) for r in got]
    assert order == sorted(order)


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 5, 8, 17):
        runs = [sorted((rng.randrange(20), r, i) for i in range(rng.randrange(12))) for r in range(k)]
        assert list(M.loser_tree(list(map(iter, runs)), lambda x: x)) == sorted(x for r in runs for x in r)


def test_files_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "FILE_RECORDS", 5)
    df = spark.createDataFrame([(k, f"http://s{k}.org/", "x" * 50) for k in range(60)], "page_id long, url string, html string").repartition(3)
    folder, names = M.work_path(spark, "many"), []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    files, stored = M.write_archives(df, folder), M.stored

    def watched(table, name):
        out = stored(table, name)
        names.extend(r.run for r in out.select("run").distinct().collect() if name == "blocks")
        return out

    monkeypatch.setattr(M, "stored", watched)
    assert M.merged_index(files, folder).count() == 60 and len(names) == files.count() >= 12
    tasks = {n.rsplit("/", 1)[1].split("-")[2] for n in names}
    assert len(tasks) > 4


def test_paths():
    assert M._path("file:/a/b") == M._path("file:///a/b") == M._path("/a/b") == M._path("hdfs://n:1/a/b") == "/a/b" and M._path("s3://c/a") == "c/a"


def test_url_key():
    assert M.url_key("https://www.B.a.org:80/x?y#z") == "org,a,b)/x?y"
    assert M.url_key("http://u@h.org") == "org,h)/" and M.url_key("odd") == ")odd" and M.url_key("") == ")"


def test_cut_archive_is_refused():
    import gzip

    raw = gzip.compress(M.record(1, "u", "2020-01-01T00:00:00Z", hashlib.sha1(b"p").hexdigest(), b"p", None))
    assert [b for *_, b in M.read_records(io.BytesIO(raw * 2))][0].endswith(b"p")
    with pytest.raises(ValueError, match="ends inside"):
        list(M.read_records(io.BytesIO(raw + raw[:-9])))


def test_empty_table_and_sql(spark, sf_dir):
    assert M.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    check(M.op4_warc(spark, sf_dir), connect(sf_dir), oracle_sql()["op4_warc"])
