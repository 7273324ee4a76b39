"""Operators over small tables, with their semantic traps."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.operators import adopt, books, canary, chunk, freq, ledger, lookup, publish, rank, search, validate, vocab


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_ranks_break_ties_by_first_occurrence(spark):
    tokens = spark.createDataFrame([("x", 1, k, w) for k, w in enumerate("b a b a c".split())], "language string, book_id long, ord long, key string")
    assert rows(freq.token_freq(tokens), "rank", "key", "count") == [(1, "b", 2), (2, "a", 2), (3, "c", 1)]
    pos = spark.createDataFrame([("k", "v", 1), ("k", "n", 2), ("k", "n", 3), ("k", "v", 4), ("z", "", 5), ("z", None, 6)], "key string, pos string, o long")
    assert rows(freq.modal_value(pos, ["key"], "pos", "o"), "key", "modal") == [("k", "v"), ("z", "")]


@pytest.mark.parametrize("run", [1000, 7])
def test_numbers_don_t_depend_on_parts(spark, run):
    rng = random.Random(run)
    data = [(rng.choice(["a", "a", "a", "b", None]), -rng.randint(1, 3), k) for k in range(300)]
    df = spark.createDataFrame(data, "g string, c int, o int").repartition(5)
    got = rank.numbered(df, ["g"], ["c", "o"], "n", run=run).collect()
    want = {g: sorted(x[1:] for x in data if x[0] == g) for g in ("a", "b", None)}
    assert len(got) == 300 and all(want[r.g][r.n - 1] == (r.c, r.o) for r in got)


def test_candidates_keep_ranks(spark):
    f = spark.createDataFrame([("x", 1, "the", 90, 9), ("x", 2, "a", 80, 9), ("x", 3, "cat", 30, 1), ("x", 4, "dog", 5, 3), ("x", 5, "rat", 29, 2)], "language string, rank int, key string, count long, doc_count long")
    stops = spark.createDataFrame([("x", "the")], "language string, word string")
    kept = freq.candidates(f, stops)
    assert rows(kept, "rank", "key") == [(3, "cat"), (4, "dog")]
    assert rows(freq.candidates(f, stops, most=1), "key") == [("cat",)]
    assert rows(freq.summary(f, kept), "types", "candidates") == [(5, 2)]


def test_chunker_golden(spark):
    p = spark.createDataFrame([("b", 1, k, "x" * n) for k, n in enumerate((5, 3, 4, 6))], "book_id string, chapter_idx int, para_idx int, text string")
    for f in (chunk.chunks, chunk.chunks_of_long_books):
        assert [r[1] for r in rows(f(p, 8, 1), "chunk_idx", "char_count")] == [8, 7, 10]
        assert rows(f(p, 8, 0), "chunk_idx", "char_count") == [(0, 8), (1, 4), (2, 6)]
    assert rows(chunk.window_of(chunk.chunks(p, 8, 1), 1, 1), "chunk_idx") == [(1,)]
    assert chunk.tasks(chunk.chunks(p, 8, 1), "6").first().task_id.startswith("s4_extract:b:")


def test_chunks_of_both_ways_agree_and_rebuild(spark):
    rng = random.Random(3)
    data = [(b, c, a, "y" * rng.randint(0, 9)) for b in "pqr" for c in range(4) for a in range(rng.randint(0, 6))]
    p = spark.createDataFrame(data, "book_id string, chapter_idx int, para_idx int, text string")
    cols = ("book_id", "chunk_idx", "from_chapter", "to_chapter", "char_count", "text")
    one, two = rows(chunk.chunks(p, 15, 1), *cols), rows(chunk.chunks_of_long_books(p, 15, 1), *cols)
    assert one == two
    for b in "pqr":
        lines = [t for x, _, _, t in data if x == b]
        parts = [r[5].split("\n") for r in one if r[0] == b]
        assert [x for k, part in enumerate(parts) for x in (part if k == 0 else part[1:])] == lines


def sequential_adopt(points, kb):
    """points: (path, pos, language, key, rank or None, [texts]); kb: (path, language, id, key, [texts])."""
    index, top, outcome = {}, {}, []
    for _, lang, i, key, texts in sorted(kb):
        index[lang, key] = [i, list(texts)]
        top[lang] = max(top.get(lang, 0), int(i[-5:]))
    for path, pos, lang, key, rank, texts in sorted(points):
        if (hit := index.get((lang, key))) is not None:
            grew = False
            for t in texts:
                if len(hit[1]) < 2 and re.sub(r"\s", "", t) not in {re.sub(r"\s", "", x) for x in hit[1]}:
                    hit[1].append(t)
                    grew = True
            outcome.append((path, pos, "merged" if grew else "no-op"))
        elif rank is None:
            outcome.append((path, pos, "rejected"))
        else:
            top[lang] = top.get(lang, 0) + 1
            index[lang, key] = [f"{lang}-grm-{top[lang]:05d}", list(texts)]
            outcome.append((path, pos, "created"))
    return {(lang, key): tuple(v) for (lang, key), v in index.items()}, sorted(outcome)


@pytest.mark.parametrize("seed", range(3))
def test_adopt_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    ex = lambda texts: [(t, "", "", "", "") for t in texts]
    texts = lambda: [rng.choice(["a b", "ab", "c", "d", "e"]) for _ in range(rng.randint(1, 2))]
    points = [(f"f{rng.randint(0, 3)}", k, rng.choice(["ja", "ko"]), rng.choice("klmn") if rng.random() < 0.9 else "", rng.choice([1, 2, None]), texts()) for k in range(25)]
    kb = [(f"p{k}", lang, f"{lang}-grm-{k + 3:05d}", key, texts()) for k, (lang, key) in enumerate((("ja", "k"), ("ja", "k"), ("ko", "z")))]
    kept = spark.createDataFrame([(p, o, g, k, "N1" if r else None, r, ex(t), k, "", "", "", ["t"], "1", "b") for p, o, g, k, r, t in points], f"path string, pos int, language string, key string, level string, level_rank int, examples {adopt.EXAMPLES}, title_zh string, structure string, structure_pattern string, explanation_zh string, tags array<string>, frequency_hint string, book_id string")
    base = spark.createDataFrame([(p, g, i, k, ex(t)) for p, g, i, k, t in kb], f"path string, language string, id string, key string, examples {adopt.EXAMPLES}")
    done = adopt.adopt(kept, base)
    index, outcome = sequential_adopt(points, kb)
    assert rows(adopt.outcomes(done), "path", "pos", "outcome") == outcome
    got = {(r.language, r.key): (r.id, [e.text for e in r.examples]) for r in done.entries.collect()}
    assert got == index
    assert {(r.language, r.key) for r in done.entries.filter("changed").collect()} == {(p[2], p[3]) for p in points for o in outcome if o[:2] == p[:2] and o[2] in ("created", "merged")}
    alone = adopt.adopt(kept.filter("level_rank is not null"), base, dedup=False)
    assert alone.entries.filter("is_new").count() == sum(p[4] is not None for p in points)


def test_screened_examples(spark):
    e = lambda t: (t, "", "", "")
    kind = "path string, pos int, language string, book_id string, chunk_text string, title_zh string, structure string, structure_pattern string, level string, explanation_zh string, examples array<struct<text:string,annot:string,reading:string,translation_zh:string>>, tags array<string>, frequency_hint string"
    source = "至[いた]って、ここに。 second sentence here. third sentence too."
    points = [("f", 0, "ja", "b", source, "t", "", "", "n3", "", [e("x" * 121), e("invented words"), e(" second sentence here "), e("third sentence too"), e("second")], None, "3"), ("f", 1, "ja", "b", source, "t", "", "", "hard", "", [e("second")], None, "3"), ("f", 2, "ko", "b", "", "t", "", "", "9", "", [e("free"), e(None)], None, None), ("f", 3, "ko", "b", "", "t", "", "", "2", "", None, None, None)]
    got = {r.pos: r for r in adopt.screened(spark.createDataFrame(points, kind)).collect()}
    assert set(got) == {0, 2}
    assert [x.text for x in got[0].examples] == ["second sentence here", "third sentence too"]
    assert got[2].level == "TOPIK9" and got[2].level_rank is None
    done = adopt.adopt(adopt.screened(spark.createDataFrame(points, kind)), spark.createDataFrame([], f"path string, language string, id string, key string, examples {adopt.EXAMPLES}"))
    entry = adopt.new_entries(done, "2026-01-01", "x").collect()
    assert [(x.id, x.level, x.provenance.frequency_hint) for x in entry] == [("ja-grm-00001", "N3", 3)]
    assert rows(adopt.counts(done), "language", "created") == [("ja", 1), ("ko", 0)]


def test_frequency_hint_takes_numbers_only(spark):
    got = spark.createDataFrame([("3",), ("2.7",), ('"3"',), ("x",), (None,)], "h string").select(adopt.frequency_hint(F.col("h"))).collect()
    assert [r[0] for r in got] == [3, 2, None, None, None]


GRAMMAR = {"path": "p", "id": "ja-grm-00001", "language": "ja", "type": "grammar", "level": "N5", "level_rank": 1, "title": "t", "structure": "", "structure_pattern": "", "explanation_zh": "", "examples": [], "related": {"cross_lang": [], "same_lang": []}, "tags": [], "provenance": None, "status": "draft", "review_note": ""}


def grammar(spark, *changes):
    return spark.createDataFrame([{**GRAMMAR, "path": f"p{k}", **c} for k, c in enumerate(changes)], schemas.GRAMMAR)


def example(text, **more):
    return {"text": text, "reading": "", "annot": "", "translation_zh": "", "source_book": "b1", "source_chapter": None, "pointer": None, **more}


def test_validate(spark):
    g = grammar(
        spark, {}, {}, {"id": "ja-grm-2"}, {"id": "ja-grm-00003", "level": "L1"}, {"id": "ja-grm-00004", "level_rank": 2}, {"id": "ja-grm-00005", "examples": [example(" "), example("x" * 121), example("y")]},
        {"id": "ja-grm-00006", "related": {"cross_lang": ["ko-grm-00009"], "same_lang": [{"id": "ja-grm-00001", "relation": "base"}, {"id": "nope", "relation": "other"}]}}, {"id": "ja-grm-00007", "status": "odd"},
    )
    v = spark.createDataFrame([], schemas.VOCAB)
    x = spark.createDataFrame([{"path": "x", "group_id": "g", "concept_zh": "", "members": {"ja": ["ja-grm-00001", "ja-grm-00404"]}, "note_zh": "", "status": "draft"}], schemas.XLANG)
    found = rows(validate.validate(g, v, x), "id", "rule", "detail")
    assert ("ja-grm-00001", "duplicate_id", "ja-grm-00001") in found and ("g", "dangling_member", "ja-grm-00404") in found
    assert [f for f in found if f[0] == "ja-grm-00006"] == [("ja-grm-00006", "dangling_ref", "ko-grm-00009"), ("ja-grm-00006", "dangling_ref", "nope")]
    assert {f[1] for f in found if f[0] == "ja-grm-00005"} == {"example_count", "example_empty", "example_length"}
    assert {(f[0], f[1]) for f in found} >= {("ja-grm-2", "id"), ("ja-grm-00003", "level"), ("ja-grm-00004", "level_rank"), ("ja-grm-00007", "status")}
    assert validate.first_errors(validate.validate(g, v, x), 2).count() == 2
    assert rows(validate.next_ids(g.filter("id <> 'ja-grm-2'"), "grm"), "next_id") == [("ja-grm-00008",)]


def test_sanitize_is_idempotent(spark):
    g = grammar(spark, {"examples": [example("x" * 130, pointer={"p": "1"}), example("b", source_book="zz"), example("c")]}, {"id": "ja-grm-00002", "status": "candidate"}, {"id": "ja-grm-00003", "status": None, "examples": []})
    b = spark.createDataFrame([("b1", "Title")], "book_id string, title_orig string")
    once = publish.sanitize(g, b)
    got = {r.id: r for r in once.collect()}
    assert set(got) == {"ja-grm-00001", "ja-grm-00003"}
    assert [(len(e.text), e.source_book) for e in got["ja-grm-00001"].examples] == [(120, "Title"), (1, "zz")]
    assert "pointer" not in got["ja-grm-00001"].examples[0].asDict()


def test_pages_and_pager(spark):
    g = spark.createDataFrame([("ja", "N5", k) for k in range(13)] + [("ja", "N4", 99)], "language string, level string, id long")
    p = publish.pages(g, ["level", "id"], 12, F.col("level"))
    assert rows(p.groupBy("bucket").agg(F.max("page").alias("pages")), "bucket", "pages") == [("N4", 1), ("N5", 2), ("all", 2)]
    langs = spark.createDataFrame([("ja",), ("vi",)], "language string")
    assert rows(publish.page_counts(langs, g, 24), "language", "items", "pages") == [("ja", 14, 1), ("vi", 0, 1)]
    shown = spark.range(1).select(publish.pager_window(F.lit(10), F.lit(24))).first()[0]
    assert shown == [1, 8, 9, 10, 11, 12, 24]
    assert rows(publish.level_counts(g), "bucket", "n") == [("N4", 1), ("N5", 13), ("all", 14)]


def test_related_titles(spark):
    g = grammar(spark, {"related": {"cross_lang": ["b", "a"], "same_lang": [{"id": "q", "relation": "base"}, {"id": "a", "relation": "other"}]}})
    r = publish.related(g, spark.createDataFrame([("a", "A")], "id string, title string")).first()
    assert [(x.ref, x.title) for x in r.cross] == [("b", None), ("a", "A")] and [x.ref for x in r.same] == ["a"]


def test_ledger(spark):
    ev = lambda seq, i, event, ts=0, **k: {"seq": seq, "id": i, "event": event, "ts": ts, "stage": "s", **k}
    log = [ev(1, "a", "enqueue", 5), ev(2, "a", "claim", 10), ev(3, "a", "enqueue", 99), ev(4, "b", "enqueue", 1), ev(5, "b", "claim", 1), ev(6, "b", "complete", 2, executor="e", prompt_tokens=3), ev(7, "b", "complete", 3), ev(8, "c", "enqueue", 2), *(ev(9 + k, "c", "claim" if k % 2 == 0 else "fail", 4, error="x" * 3000) for k in range(6)), ev(20, "d", "claim")]
    s = ledger.state(spark.createDataFrame(log, schemas.TASK_EVENT)).cache()
    got = {r.id: r for r in s.collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].status, got["a"].attempts, got["a"].enqueue_ts) == ("running", 1, 5)
    assert (got["b"].status, got["b"].executor, got["b"].prompt_tokens) == ("done", "e", None)
    assert (got["c"].status, got["c"].attempts, len(got["c"].error)) == ("failed", 3, 2000)
    assert [r.id for r in ledger.pending(s, "s", 2000).collect()] == ["a"]
    assert ledger.pending(s, "s", 100).count() == 0
    assert rows(ledger.report(s), "status", "n") == [("done", 1), ("failed", 1), ("running", 1)]
    work = spark.createDataFrame([("a",), ("b",)], "task_id string")
    assert rows(ledger.not_done(work, s), "task_id") == [("a",)]


def test_register_is_idempotent_and_joins_equal_files(spark):
    f = spark.createDataFrame([("ja", "p1", "h1", "t1", 1), ("ja", "p2", "h2", "t2", 2), ("ja", "p3", "h1", "t3", 3), ("ko", "p4", "h0", "t4", 4)], "lang string, path string, sha256 string, title string, ord int")
    kind = "book_id string, title_orig string, language string, epub_path string, sha256 string"
    old = spark.createDataFrame([("book-ko-007", "T", "ko", "old", "h0"), ("book-ja-002", "U", "ja", "gone", "h9")], kind)
    once = books.register(f, old)
    assert rows(once, "book_id", "epub_path", "is_new") == [("book-ja-002", "gone", False), ("book-ja-003", "p3", True), ("book-ja-004", "p2", True), ("book-ko-007", "p4", False)]
    again = books.register(f, once.drop("is_new").select(*[c.split()[0] for c in kind.split(", ")]))
    assert not again.filter("is_new").count() and again.count() == 4


def test_vocab_takes_last_homograph_and_first_gloss(spark):
    f = spark.createDataFrame([("ja", 1, "行", "イク", 9, 2), ("ja", 40, "行", "ギョウ", 3, 1), ("ja", 2, "私-代名詞", "", 9, 9), ("ko", 2000, "x", "", 1, 1), ("ko", 3, "y", "r", 1, 1)], "language string, rank int, key string, reading string, count long, doc_count long")
    g = spark.createDataFrame([("ja", "行", "second", "", None, "b", 0), ("ja", "行", "first", "noun", "漢", "a", 1), ("ko", "x", "g", "", None, "a", 0), ("ko", "y", "g", None, "", "a", 0)], "language string, word string, gloss_zh string, pos string, hanja string, file string, item int")
    got = {r.word: r for r in vocab.entries(f, g).collect()}
    assert set(got) == {"行", "y"}
    assert (got["行"].id, got["行"].reading, got["行"].gloss_zh, got["行"].gloss_detail_zh) == ("ja-voc-00040", "ぎょう", "first", "汉字词源：漢")
    assert (got["y"].reading, got["y"].pos, got["y"].gloss_detail_zh) == ("", "", "")
    b = vocab.batches(spark.createDataFrame([("x", k, f"w{k}") for k in range(1, 46)], "language string, rank int, key string"))
    assert rows(b.withColumn("n", F.size("words")), "start", "n") == [(0, 20), (20, 20), (40, 5)]


def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [(k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for k in range(40)] + [(99, None)]
    probes = [(k, texts[rng.randrange(40)][1][3 : 3 + rng.choice([4, 7, 8, 14, 15, 16, 23, 30, 31, 32, 40])]) for k in range(60)]
    probes = [p for p in probes if p[1]]
    got = canary.containment(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(probes, "n int, probe string"))
    assert rows(got, "n", "id") == sorted((n, k) for n, p in probes for k, t in texts if t and p in t)


def test_canary_pick_and_leaks(spark):
    p = spark.createDataFrame([("b", 2, 0, "z" * 60), ("b", 3, 1, "w" * 70), ("b", 3, 0, "short"), ("c", 1, 0, "x" * 300)], "book_id string, chapter_idx int, para_idx int, text string")
    picked = canary.pick(p)
    assert rows(picked, "book_id", "canary") == [("b", "w" * 40)]
    out = spark.createDataFrame([("... " + "w" * 20,), ("clean",)], "text string")
    assert rows(canary.leaks(out, picked), "book_id") == [("b",)]


def test_first_annotation(spark):
    ex = spark.createDataFrame([(1, "財布を落とす"), (2, "ない"), (3, "落とす人")], "id int, text string")
    ch = spark.createDataFrame([("a", "財布を落とす人"), ("b", "財布[サイフ]を落とす人"), ("c", "財布[さいふ]を落とす")], "path string, chunk_text string")
    assert rows(lookup.first_annotation(ex, ch), "id", "annot") == [(1, "財布[サイフ]を落とす")]
    assert rows(lookup.first_annotation(ex, ch, need_reading=False), "id", "annot") == [(1, "財布を落とす"), (3, "落とす人")]


def test_annotate_and_rewrite(spark):
    g = grammar(spark, {"examples": [example("至って"), example("財布")]})
    done = adopt.annotate(g, spark.createDataFrame([("ja-grm-00001", 0, "至[いた]って"), ("ja-grm-00001", 1, "財布x")], "id string, i int, annot string")).first()
    assert done.n_ok == 1 and [e.annot for e in done.examples] == ["至[いた]って", ""]
    new = spark.createDataFrame([("ja-grm-00001", "new", None, None, None, list("abcdefg"))], "id string, title string, structure string, structure_pattern string, explanation_zh string, tags array<string>")
    got = adopt.rewrite(g, new).first()
    assert got.title == "new" and got.tags == list("abcde") and got.structure == ""


def test_search(spark):
    docs = spark.createDataFrame([(1, "cat dog", "en", 2), (2, "cat cat", "en", 1), (3, "cat", "de", 3), (4, "", "en", 4)], "id long, text string, lang string, level int")
    post = search.index(docs, "id", "text")
    assert rows(post.filter("term = 'cat'"), "id", "tf", "doc_len") == [(1, 1, 2), (2, 2, 2), (3, 1, 1)]
    hit = search.search(post, docs.drop("text"), "CAT", {"lang": ["en"]})
    assert [r.id for r in hit.collect()] == [2, 1] and hit.first().total == 2
    assert [r.id for r in search.search(post, docs.drop("text"), "cat", sort="-level", size=2, page=2).collect()] == [2]
    assert search.search(post, docs.drop("text"), "").count() == 0
    assert rows(search.facet_counts(docs, "lang"), "value", "n") == [("de", 1), ("en", 3)]


@pytest.mark.parametrize("need_reading", [True, False])
def test_equal_examples_meet_the_chunks_once_slice_by_slice(spark, monkeypatch, need_reading):
    monkeypatch.setattr(lookup, "FIRST", 4)
    met = []

    def meetings(texts, needles, *columns, own=lookup.meetings):
        found = own(texts, needles, *columns)
        met.append(found.count())
        return found

    monkeypatch.setattr(lookup, "meetings", meetings)
    rare, late = "only one chunk holds 漢字 and 山 of this", "0123456789ab" + " " * 20
    chunks = [(f"{k:04d}", "all chunks hold 漢字[よみ] and 山[やま] of this") for k in range(300)] + [("5000", "x 0123456789山[やま]"), ("6000", rare.replace("字", "字[じ]").replace("山", "山[やま]"))]
    examples = [(k, "all chunks hold 漢字 and 山 of this") for k in range(200)] + [(900, rare), (901, late), (902, "nowhere at all, not even its half")]
    got = rows(lookup.first_annotation(spark.createDataFrame(examples, "id int, text string"), spark.createDataFrame(chunks, "path string, chunk_text string").repartition(3), need_reading), "id", "annot")
    assert got == [*((k, chunks[0][1]) for k in range(200)), (900, chunks[-1][1])] + ([] if need_reading else [(901, "0123456789")])
    assert 0 < sum(met) < 40


@pytest.mark.parametrize("repeated", [False, True])
def test_document_freq_equals_token_freq_without_rows_by_document(spark, repeated):
    docs = [(1, "x", "b a B, c."), (2, "x", "Ο ΣΑΣ'Α ΟΔΟΣ ΣΑΣ İx İX c"), (3, None, "a"), (4, "x", None), (5, "y", "...")] + [(2, "x", "c d")] * repeated
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    columns = ("language", "rank", "key", "count", "doc_count")
    by = lambda f: sorted(map(str, f.select(*columns).collect()))
    found = freq.document_freq(df)
    assert by(found) == by(freq.token_freq(freq.document_tokens(df)))
    assert {r.key for r in found.filter("language = 'x'").collect()} >= {"οδος", "σας", "α", "i̇x"}
    assert found.filter("key = 'c'").first().asDict().items() >= {"count": 2 + repeated, "doc_count": 2}.items()


def test_lookup_reads_the_texts_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The cat, the dog"), (2, "..."), (3, "THE of of"), (4, None)], "id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    postings, n, mean = search.lookup(spark.read.parquet(str(tmp_path / "d")), "id", "text", "the OF")
    assert (n, mean) == (2, 3.5) and rows(postings, "term", "id", "tf") == [("of", 3, 2), ("the", 1, 2), ("the", 3, 1)]
    assert str(tmp_path / "d") not in postings._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("repeated", [False, True])
def test_index_without_a_shuffle(spark, monkeypatch, repeated):
    monkeypatch.setattr(search, "RUN", 3)
    docs = [(1, "b a b"), (2, None), (3, "..."), (4, "a"), (5, "C c, C d a b"), (None, "x x")] + [(4, "b")] * repeated
    df = spark.createDataFrame(docs, "id long, text string").coalesce(1)
    found = search.index(df, "id", "text")
    want = {}
    for i, text in docs:
        own = re.findall(r"\w+", (text or "").lower())
        for k, w in enumerate(own):
            want.setdefault((w, i, len(own)), []).append(k)
    got = {(r.term, r.id, r.doc_len): (r.tf, sorted(r.positions)) for r in found.collect()}
    assert got == {k: (len(v), sorted(v)) for k, v in want.items()} or repeated and got[("b", 4, 1)] == (1, [0])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("Aggregate" in plan) == repeated


def test_plain_text_is_that_of_the_bases(spark):
    texts = ["a漢[か]b", "漢[a][b]c", "[x]y", "a[[x]b]", "a[]b", "𠀋[か]𠀋[", "", "no"]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", lookup._plain(F.col("t")).alias("plain")).collect():
        assert r.plain == "".join(m[1] for m in re.finditer(r"([^\[\]]+)(?:\[([^\[\]]+)\])?", r.t))
