"""Readers and writers over small files made here."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.functions import tokenizers
from lexiforge.sources import files, sinks


def epub(chapters, css="", title="T"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        items = "".join(f'<item id="i{k}" href="{n}" media-type="application/xhtml+xml"/>' for k, (n, _) in enumerate(chapters))
        spine = "".join(f'<itemref idref="i{k}"/>' for k in range(len(chapters))) + '<itemref idref="absent"/>'
        z.writestr("OPS/p.opf", f'<package xmlns:dc="urn:d"><metadata><dc:title>{title}</dc:title></metadata><manifest>{items}<item id="s" href="s.css" media-type="text/css"/></manifest><spine>{spine}</spine></package>')
        z.writestr("OPS/s.css", css)
        for name, body in chapters:
            z.writestr(f"OPS/{name}", body)
    return out.getvalue()


def test_epub(spark, tmp_path):
    long_ = "<h1>One</h1>" + "<p>" + "word " * 30 + "</p>" * 1
    book = epub([("a.xhtml", long_), ("toc.xhtml", long_), ("b.xhtml", "<p>short</p>"), ("c.xhtml", long_.replace("One", "Two") + "<p><ruby>漢<rt>かん</rt></ruby></p>")], "x{writing-mode:VERTICAL-rl}")
    got = files.read_epub(book)
    assert [(c["chapter_idx"], c["title"]) for c in got["chapters"]] == [(1, "One"), (2, "Two")]
    assert got["script"] == "vertical" and got["has_ruby"] and got["title"] == "T"
    for lang, name, raw in (("ko", "b.epub", book), ("ja", "a.epub", b"broken"), ("xx", "c.epub", book)):
        (tmp_path / lang).mkdir()
        (tmp_path / lang / name).write_bytes(raw)
    found = files.scan_corpus(spark, str(tmp_path))
    assert [r.lang for r in found.orderBy("lang_ord", "path").collect()] == ["ja", "ko"]
    rows = files.scan_epub(found.select(F.col("lang").alias("book_id"), F.col("lang").alias("title_orig"), "content")).orderBy("book_id", "chapter_idx").collect()
    assert [(r.book_id, r.status, r.chapter_idx) for r in rows] == [("ja", "failed_unpack", None), ("ko", "unpacked", 1), ("ko", "unpacked", 2)]


def test_stopwords(spark, tmp_path):
    (tmp_path / "xx.txt").write_text("# no\n a \n\n #kept\na\nb\n", encoding="utf-8")
    assert {r.word for r in files.scan_stopwords(spark, str(tmp_path)).collect()} == {"a", "#kept", "b"}


def test_candidates_wrapped_bare_and_broken(spark, tmp_path):
    point = {"title_zh": "t", "level": "N5", "examples": [{"text": "x"}], "frequency_hint": 3}
    (tmp_path / "a.json").write_text(json.dumps({"result": {"grammar_points": [point]}, "chunk_text": "c", "book_id": "b"}))
    (tmp_path / "b.json").write_text(json.dumps({"grammar_points": [point, {**point, "frequency_hint": "3"}]}))
    (tmp_path / "c.json").write_text("{broken")
    rows = files.scan_candidates(spark, str(tmp_path)).orderBy("path").collect()
    assert [(len(r.points), r.chunk_text, r.book_id) for r in rows] == [(1, "c", "b"), (2, "", "")]
    assert [p.frequency_hint for p in rows[1].points] == ["3", '"3"']
    assert files.scan_chunk_texts(spark, str(tmp_path)).count() == 1


def test_kb_round_trip(spark, tmp_path):
    d = tmp_path / "grammar" / "ja"
    d.mkdir(parents=True)
    (d / "ja-grm-00001.yaml").write_text("id: ja-grm-00001\nlanguage: ja\nlevel: N3\nlevel_rank: 3\ntitle: 題\nexamples:\n- text: 例\n  pointer: {page: 3}\nprovenance:\n  discovered_in: [b1, b2]\n", encoding="utf-8")
    (d / "ja-grm-00002.yaml").write_text("{broken", encoding="utf-8")
    row = files.scan_kb(spark, str(tmp_path), "grammar").collect()
    assert len(row) == 1 and row[0].examples[0].pointer == {"page": "3"} and row[0].provenance.discovered_is_scalar is False
    text = sinks.yaml_of(files.scan_kb(spark, str(tmp_path), "grammar")).first().yaml
    assert text.startswith("id: ja-grm-00001") and "題" in text
    sinks.write_entries(files.scan_kb(spark, str(tmp_path), "grammar"), str(tmp_path / "out"))
    assert spark.read.schema(schemas.GRAMMAR).json(str(tmp_path / "out")).count() == 1
    assert files.scan_books(spark, str(tmp_path / "none.yaml")).count() == 0
    (tmp_path / "books.yaml").write_text("- book_id: b1\n  language: ja\n- book_id: b2\n  language: ko\n")
    assert [(b.book_id, b.book_ord) for b in files.scan_books(spark, str(tmp_path / "books.yaml")).orderBy("book_ord").collect()] == [("b1", 0), ("b2", 1)]


def test_freq_tsv_and_gloss(spark, tmp_path):
    freq = spark.createDataFrame([("ja", 1, "私", "ワタシ", "", 5, 2)], "language string, rank int, key string, reading string, pos string, count long, doc_count long")
    sinks.write_freq_tsv(freq, str(tmp_path / "f"))
    row = files.scan_freq_tsv(spark, str(tmp_path / "f" / "language=ja")).first()
    assert (row.rank, row.key, row["count"]) == (1, "私", 5)
    (tmp_path / "gloss_0.json").write_text(json.dumps({"words": ["a"], "gloss": [{"word": "a", "gloss_zh": "g"}, {"word": "", "gloss_zh": "g"}, {"word": "b"}]}))
    assert [r.word for r in files.scan_gloss(spark, str(tmp_path / "gloss_0.json")).collect()] == ["a"]


def test_tutorial_text_and_books(spark):
    t = spark.createDataFrame([("x", "N5", "draft", "```markdown\n# A\n```")], schemas.TUTORIAL)
    assert sinks.tutorial_text(t).first().value == "---\nid: x\nlevel: N5\nstatus: draft\n---\n\n# A\n"
    assert "sha256" not in sinks.publish_books(spark.createDataFrame([], schemas.BOOK)).columns


def test_tokens(spark):
    rows = spark.createDataFrame([("b", 1, 0, "Ab cd​, Ef", ""), ("b", 1, 1, "", "")], schemas.PARAGRAPH)
    got = tokenizers.tokens(rows, "vi").orderBy("a", "i").collect()
    assert [(t.s, t.b, t.i) for t in got] == [("Ab", "ab", 0), ("cd", "cd", 1), ("Ef", "ef", 2)]
    tokenizers.register("zz", "json", lambda text: [{"s": text, "b": "", "r": None, "p": "", "rs": None}] if text != "Ab cd​, Ef" else 1 / 0)
    assert [t.s for t in tokenizers.tokens(rows.union(spark.createDataFrame([("b", 2, 0, "q", "")], schemas.PARAGRAPH)), "zz").collect()] == ["q"]


def test_words_by_book_joins_runs_before_the_shuffle(spark):
    kind = "book_id string, c int, a int, i int, s string, b string"
    tokens = [(b, 0, a, i, f"W{a}{i}", f"w{a}{i}") for b in ("x", "y") for a in range(4) for i in range(5)]
    want = {b: (20, " ".join(f"W{a}{i}/w{a}{i}" for a in range(4) for i in range(5))) for b in ("x", "y")}
    for rows in (tokens, tokens[::-1], tokens[::2] + tokens[1::2]):
        found = tokenizers.words_by_book(spark.createDataFrame(rows, kind).repartition(3, "i"))
        assert {r.book_id: (r.n, r.words) for r in found.collect()} == want
    one = tokenizers.words_by_book(spark.createDataFrame([*tokens, ("z", 0, 0, 0, None, "b")], kind).coalesce(1))
    assert {r.book_id: (r.n, r.words) for r in one.collect()} == want | {"z": (1, "")}
    assert "ObjectHashAggregate" in (plan := one._jdf.queryExecution().executedPlan().toString()) and "MapInArrow" in plan


def test_whole_files_by_workers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HELD", 5)
    want = {}
    for k in range(40):
        name = tmp_path / f"d{k % 3}" / "deep" / f"{k} ä%20.md"
        name.parent.mkdir(parents=True, exist_ok=True)
        name.write_bytes(b"x" * k + b"\xff")
        want[f"file:{name}"] = name.read_bytes()
    for odd in ("d0/_hidden.md", "d0/.hidden.md", "d0/a.txt", "_tmp/x.md"):
        (tmp_path / odd).parent.mkdir(exist_ok=True)
        (tmp_path / odd).write_text("no")
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        found = files.whole_files(spark, root, "*.md")
        assert {r.path: bytes(r.content) for r in found.collect()} == want
        assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
    assert files.whole_files(spark, f"{tmp_path}/d0", "*.epub").count() == 0
    with pytest.raises(FileNotFoundError):
        files.whole_files(spark, f"{tmp_path}/absent", "*.md")


def test_books_of_scan_epub_share_batches(spark, monkeypatch):
    book = epub([("a.xhtml", "<h1>One</h1><p>" + "word " * 30 + "</p>"), ("b.xhtml", "<h1>Two</h1><p>" + "word " * 40 + "</p>")])
    rows = [(k, f"t{k}", b"broken" if k % 3 == 0 else book) for k in range(12)]
    found = files.scan_epub(spark.createDataFrame(rows, "book_id long, title_orig string, content binary").coalesce(1))
    assert sorted((r.book_id, r.status, r.chapter_idx or 0, r.title, len(r.paras or []), r.char_count or 0) for r in found.collect()) == sorted(
        x for k in range(12) for x in ([(k, "failed_unpack", 0, None, 0, 0)] if k % 3 == 0 else [(k, "unpacked", 1, "One", 2, 152), (k, "unpacked", 2, "Two", 2, 202)])
    )
    assert found.dtypes[0] == ("book_id", "bigint") and "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()


def test_entries_with_one_id_are_files_once(spark, tmp_path):
    kind = "id string, language string, title string, path string"
    entries = spark.createDataFrame([("ja-grm-00001", "ja", "題: #1 𠀋\n\n yes", "p"), ("ja-grm-00001", "ja", "題: #1 𠀋\n\n yes", "q"), ("ko-grm-00002", "ko", "null", "p")], kind)
    assert sinks.write_entry_files(entries, str(tmp_path), "grammar") == 3
    got = {r.id: r.title for r in files.scan_kb(spark, str(tmp_path), "grammar").collect()}
    assert got == {"ja-grm-00001": "題: #1 𠀋\n\n yes", "ko-grm-00002": "null"}


def test_candidate_files_stay_small(spark, tmp_path):
    from lexiforge.plans import source_queries

    docs = [(k, "text", "en", "src", 4) for k in range(1, 40_000, 777)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    path = source_queries._candidate_files(spark, str(tmp_path)).removeprefix("file:")
    assert sum(name.startswith("src-") for name in os.listdir(path)) == 4
