"""Queries of the sources and sinks: a table is written out in a source's format, scanned back, and held against SQL over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge import schemas, storage
from lexiforge.functions.decode import decode_text as decoded_text
from lexiforge.functions.tokenizers import tokens, words_by_book
from lexiforge.operators import freq
from lexiforge.plans.queries import _TOKENS_SQL, _UWS, STOPS, query, read
from lexiforge.sources import files, sinks

_LINES = "SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS a FROM documents"


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters of their source."""
    paras = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.concat(x, F.lit("!")).alias("annot")))
    return read(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("chapter_idx"), F.col("lang").alias("title"), paras.alias("paras"), F.col("n_chars").alias("char_count"))


@query(f"SELECT source AS book_id, doc_id::INTEGER AS chapter_idx, a::INTEGER AS para_idx, sha256(line) AS text, sha256(line || '!') AS annot FROM ({_LINES})")
def scan_chapters(spark, sf_dir):
    path = storage.work_path(spark, "chapters")
    _chapters(spark, sf_dir).write.json(path)
    rows = files.explode_paragraphs(files.scan_chapters(spark, path))
    return rows.select("book_id", "chapter_idx", "para_idx", F.sha2("text", 256).alias("text"), F.sha2("annot", 256).alias("annot"))


_WORDS_SQL = rf"""w AS (SELECT doc_id, a, list_filter(string_split_regex(line, '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '') AS w FROM ({_LINES})),
k AS (SELECT doc_id, a, unnest(w) AS s, generate_subscripts(w, 1) - 1 AS i FROM w)"""


def _tokens(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("book_id"), F.lit(0).alias("chapter_idx"), F.posexplode(F.split("text", "\n")).alias("para_idx", "text"))
    return tokens(lines.withColumn("annot", F.lit("")), "en")


@query(f"WITH {_WORDS_SQL} SELECT doc_id::VARCHAR AS book_id, 0 AS c, a::INTEGER AS a, i::INTEGER AS i, s, lower(s) AS b FROM k")
def tokenize_book(spark, sf_dir):
    return _tokens(spark, sf_dir).select("book_id", "c", "a", "i", "s", "b")


@query(f"WITH {_WORDS_SQL} SELECT doc_id::VARCHAR AS book_id, count(*) AS n, sha256(string_agg(s || '/' || lower(s), ' ' ORDER BY a, i)) AS words FROM k GROUP BY doc_id")
def scan_tokens(spark, sf_dir):
    path = storage.work_path(spark, "tokens")
    _tokens(spark, sf_dir).write.json(path, compression="lz4")
    rows = words_by_book(files.scan_tokens(spark, path))
    return rows.select("book_id", "n", F.sha2("words", 256).alias("words"))


@query(f"WITH {_TOKENS_SQL} SELECT language, rank, key, '' AS reading, 'w' AS pos, count, doc_count FROM r")
def write_freq_tsv(spark, sf_dir):
    path = storage.work_path(spark, "freq")
    table = freq.document_freq(read(spark, sf_dir, "documents"))
    sinks.write_freq_tsv(table.withColumns({"reading": F.lit(""), "pos": F.lit("w")}), path)
    return files.scan_freq_tsv(spark, path).select("language", "rank", "key", F.coalesce("reading", F.lit("")).alias("reading"), "pos", "count", "doc_count")


_STOP_ROWS = ", ".join(f"('{k}', '{w}')" for k, v in STOPS.items() for w in sorted(set(v.split())))


@query(f"SELECT s.language, s.word, count(DISTINCT doc_id) AS docs FROM (VALUES {_STOP_ROWS}) s(language, word) LEFT JOIN documents d ON d.lang = s.language AND contains(d.text, s.word) GROUP BY ALL")
def scan_stopwords(spark, sf_dir):
    """The word lists as files with comments, blanks and repeats; how many documents hold each word anywhere."""
    path = storage.work_path(spark, "stopwords", make=True)
    for language, words in STOPS.items():
        lines = [x for w in words.split() for x in (f"  {w}　", "", "# not " + w)] + words.split()[:2]
        storage.write_file(spark, f"{path}/{language}.txt", "\n".join(lines) + "\n")
    words = files.scan_stopwords(spark, path)
    docs = read(spark, sf_dir, "documents").select(F.col("lang").alias("language"), "doc_id", "text")
    found = docs.join(F.broadcast(words), "language").filter(F.contains("text", F.col("word")))  # a few dozen words
    return words.join(found.groupBy("language", "word").agg(F.countDistinct("doc_id").alias("docs")), ["language", "word"], "left").select("language", "word", F.coalesce("docs", F.lit(0)).cast("long").alias("docs"))


def _json_files(rows: DataFrame, name: str, group: str) -> str:
    """(group, json) as one JSON array a group, each in a file of its own."""
    path = storage.work_path(rows.sparkSession, name, make=True)
    whole = rows.groupBy(group).agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("json")), ","), F.lit("]")).alias("value"))
    sinks.write_files(whole.select(F.concat(group, F.lit(".json")).alias("name"), "value"), path).count()
    return path


def _candidate_files(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    example = F.array(F.struct(F.element_at(F.split("text", "\n"), 1).alias("text"), F.lit("t").alias("translation_zh")))
    point = lambda hint: F.struct(F.col("source").alias("title_zh"), F.lit("s").alias("structure"), F.col("lang").alias("level"), example.alias("examples"), hint.alias("frequency_hint"))
    points = F.array(point(F.to_json(F.struct(F.col("n_chars").alias("n")))), point(F.lit(None).cast("string")))
    own = F.struct(F.col("doc_id").cast("string").alias("book_id"), F.lit(7).alias("chunk_idx"), F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("chunk_text"), F.when(F.col("doc_id") % 2 == 0, F.struct(points.alias("grammar_points"))).alias("result"), F.when(F.col("doc_id") % 2 == 1, points).alias("grammar_points"))
    # every tenth document in a file of its own, every fifth of those broken; the others by source, of some thousand ids each, so that files don't grow
    file = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("d"), "doc_id")).otherwise(F.concat_ws("-", "source", F.expr("doc_id div 10000")))
    return _json_files(docs.select(file.alias("file"), F.when(F.col("doc_id") % 50 == 0, "{broken").otherwise(F.to_json(own)).alias("json")), "candidates", "file")


@query("""SELECT doc_id::VARCHAR AS book_id, 7 AS chunk_idx, sha256(CASE WHEN doc_id % 3 <> 0 THEN text ELSE '' END) AS chunk_text, 2 AS points, source AS title_zh, lang AS level, string_split(text, chr(10))[1] AS example,
json_object('n', n_chars)::VARCHAR AS hint FROM documents WHERE doc_id % 50 <> 0""")
def scan_candidates(spark, sf_dir):
    """Candidate files, wrapped and bare; broken ones are left out.  hint: a quoted value stays quoted."""
    rows = files.scan_candidates(spark, _candidate_files(spark, sf_dir))
    p = F.get("points", F.lit(0))
    return rows.select("book_id", "chunk_idx", F.sha2("chunk_text", 256).alias("chunk_text"), F.size("points").alias("points"), p["title_zh"].alias("title_zh"), p["level"].alias("level"), p["examples"][0]["text"].alias("example"), F.get_json_object(F.concat(F.lit('{"h":'), p["frequency_hint"], F.lit("}")), "$.h").alias("hint"))


@query("SELECT sha256(text) AS chunk_text, count(*) AS n FROM documents WHERE doc_id % 50 <> 0 AND doc_id % 3 <> 0 AND text <> '' GROUP BY 1")
def scan_chunk_texts(spark, sf_dir):
    rows = files.scan_chunk_texts(spark, _candidate_files(spark, sf_dir))
    return rows.groupBy(F.sha2("chunk_text", 256).alias("chunk_text")).agg(F.count("*").alias("n"))


@query("SELECT source || doc_id AS word, text AS gloss_zh, lang AS pos, CASE WHEN doc_id % 2 = 0 THEN lang END AS hanja FROM documents WHERE text <> '' AND doc_id % 7 <> 0")
def scan_gloss(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    item = F.struct(F.when(F.col("doc_id") % 7 != 0, F.concat("source", "doc_id")).otherwise("").alias("word"), F.col("text").alias("gloss_zh"), F.col("lang").alias("pos"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("hanja"))
    rows = docs.groupBy((F.col("doc_id") % 16).alias("file")).agg(F.collect_list("source").alias("words"), F.collect_list(item).alias("gloss"))
    path = storage.work_path(spark, "gloss")
    rows.select("file", F.to_json(F.struct("words", "gloss")).alias("value")).repartition("file").write.partitionBy("file").text(path)
    return files.scan_gloss(spark, path).select("word", "gloss_zh", "pos", "hanja")


def _entries(spark, sf_dir) -> DataFrame:
    """Documents as grammar entries with two examples."""
    docs = read(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    lang = F.when(F.col("lang") == "en", "ko").when(F.col("lang") == "de", "ja").when(F.col("lang") == "fr", "th").otherwise("vi")
    ident = F.format_string("%s-grm-%05d", lang, "doc_id")
    example = lambda k, pointer: F.struct(F.get(lines, F.lit(k)).alias("text"), F.lit("").alias("reading"), F.lit("").alias("annot"), F.lit("t: #1").alias("translation_zh"), F.col("source").alias("source_book"), F.lit(None).cast("int").alias("source_chapter"), pointer.cast("map<string,string>").alias("pointer"))
    examples = F.filter(F.array(example(0, F.lit(None)), example(1, F.create_map(F.lit("page"), F.col("doc_id").cast("string")))), lambda e: F.coalesce(e["text"], F.lit("")) != "")
    related = F.struct(F.array(F.lit("ja-grm-00001")).alias("cross_lang"), F.array(F.struct(ident.alias("id"), F.lit("base").alias("relation"))).alias("same_lang"))
    prov = F.struct(F.array("source").alias("discovered_in"), (F.col("doc_id") % 2 == 0).alias("discovered_is_scalar"), F.lit(None).cast("int").alias("first_seen_chapter"), F.col("n_chars").cast("int").alias("frequency_hint"), F.lit("engine").alias("extracted_by"), F.lit("2026-01-01").alias("extracted_at"))
    return docs.select(
        F.lit("").alias("path"), ident.alias("id"), lang.alias("language"), F.lit("grammar").alias("type"), F.lit("N5").alias("level"), F.lit(1).alias("level_rank"), F.col("text").alias("title"), F.lit("yes").alias("structure"), F.lit("null").alias("structure_pattern"),
        F.lit("1.0").alias("explanation_zh"), examples.alias("examples"), related.alias("related"), F.array("lang", F.lit("on")).alias("tags"), prov.alias("provenance"), F.lit("draft").alias("status"), F.lit("").alias("review_note"),
    )


_LANG = "CASE lang WHEN 'en' THEN 'ko' WHEN 'de' THEN 'ja' WHEN 'fr' THEN 'th' ELSE 'vi' END"


@query(f"""WITH e AS (SELECT *, {_LANG} AS language, list_filter(string_split(text, chr(10))[1:2], lambda x: x <> '') AS ex FROM documents)
SELECT language || '-grm-' || printf('%05d', doc_id) AS id, language, sha256(text) AS title, 'yes' AS structure, 'null' AS structure_pattern, '1.0' AS explanation_zh, len(ex) AS examples, sha256(array_to_string(ex, chr(31))) AS texts,
 language || '-grm-' || printf('%05d', doc_id) AS same, 'base' AS relation, lang || ' on' AS tags, source AS found, n_chars::INTEGER AS hint, '2026-01-01' AS extracted_at FROM e""")
def scan_kb_entries(spark, sf_dir):
    """One YAML file an entry, written and scanned back; texts that look like other kinds stay texts."""
    root = storage.work_path(spark, "kb", make=True)
    sinks.write_entry_files(_entries(spark, sf_dir), root, "grammar")
    e = files.scan_kb(spark, root, "grammar")
    return e.select(
        "id", "language", F.sha2("title", 256).alias("title"), "structure", "structure_pattern", "explanation_zh", F.size("examples").cast("long").alias("examples"),
        F.sha2(F.array_join(F.transform("examples", lambda x: x["text"]), "\x1f"), 256).alias("texts"), F.col("related.same_lang")[0]["id"].alias("same"), F.col("related.same_lang")[0]["relation"].alias("relation"), F.array_join("tags", " ").alias("tags"),
        F.col("provenance.discovered_in")[0].alias("found"), F.col("provenance.frequency_hint").alias("hint"), F.col("provenance.extracted_at").alias("extracted_at"),
    )


@query("SELECT source AS book_id, row_number() OVER (ORDER BY source)::INTEGER - 1 AS book_ord, 'Titel: ' || source AS title_orig, count(*)::INTEGER AS chapter_count, sum(n_chars)::BIGINT AS total_chars FROM documents GROUP BY source")
def scan_books(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").cast("int").alias("chapter_count"), F.sum("n_chars").alias("total_chars"))
    rows = rows.withColumn("book_ord", F.row_number().over(W.orderBy("source")) - 1)  # a row a book
    made = {"book_id": F.col("source"), "title_orig": F.concat(F.lit("Titel: "), "source"), "status": F.lit("unpacked")}
    own = rows.withColumns(made)
    path = storage.work_path(spark, "books", make=True) + "/books.yaml"
    sinks.write_books(own.select(*[F.col(f.name) if f.name in own.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.BOOK]), path)
    return files.scan_books(spark, path).select("book_id", "book_ord", "title_orig", "chapter_count", "total_chars")


@query("SELECT source AS book_id, 'Titel' AS title_orig, true AS inside FROM documents GROUP BY source")
def publish_books_json(spark, sf_dir):
    """Books as published JSON: the internal columns are gone."""
    rows = read(spark, sf_dir, "documents").groupBy(F.col("source").alias("book_id")).agg(F.first(F.lit("Titel")).alias("title_orig"), F.first(F.lit("h")).alias("sha256"), F.first(F.lit("p")).alias("epub_path"))
    path = storage.work_path(spark, "published")
    sinks.publish_books(rows).write.json(path)
    found = spark.read.json(path)
    return found.select("book_id", "title_orig", F.lit(not {"sha256", "epub_path"} & set(found.columns)).alias("inside"))


def _books(batches):
    """(book, lang, doc_id, text) in order of books and documents to (name, value): each book's e-book file."""
    from itertools import groupby

    import pyarrow as pa

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    names, values, size = [], [], 0
    for book, own in groupby(rows, lambda r: r[0]):
        own = list(own)
        names.append(f"{own[0][1]}/{book}.epub")
        values.append(_book(book, own[0][1], [r[2:] for r in own]))
        size += len(values[-1])
        if size > files.HELD:
            yield pa.RecordBatch.from_pydict({"name": names, "value": values})
            names, values, size = [], [], 0
    yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "value": pa.array(values, pa.binary())})


def _book(book_id: str, lang: str, docs: list[tuple]) -> bytes:
    """The e-book file of a book's (doc_id, text)."""
    import io
    import zipfile
    from html import escape

    out, names = io.BytesIO(), [f"c{d}.xhtml" for d, _ in docs]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="o/b.opf"/></rootfiles></container>')
        items = "".join(f'<item id="i{k}" href="{n}"/>' for k, n in enumerate(["nav.xhtml", *names]))
        refs = "".join(f'<itemref idref="i{k}"/>' for k in [*range(len(names) + 1), 999_999])
        z.writestr("o/b.opf", f'<package><title>{book_id}</title><item id="css" media-type="text/css" href="s.css"/>{items}{refs}</package>')
        z.writestr("o/s.css", "p{writing-mode:Vertical-rl}" if lang == "de" else "p{}")
        z.writestr("o/nav.xhtml", "<p>" + "no chapter " * 20 + "</p>")
        for name, (doc, text) in zip(names, docs, strict=True):
            lines = [escape(x, quote=False) for x in (text or "").split("\n")]
            ruby = "<ruby>漢<rp>(</rp><rt>かん</rt><rp>)</rp></ruby>" if doc % 5 == 0 else ""
            head = f"<h2>T {doc}</h2>" if sum(bool(x.strip()) for x in [ruby + lines[0], *lines[1:]]) >= 3 else ""
            z.writestr(f"o/{name}", f"<html><body>{head}<p>{ruby}" + "</p><p>".join(lines) + "</p></body></html>")
    return out.getvalue()


_BOOKS_SQL = rf"""l AS (SELECT doc_id, lang, lang || '-' || source || '-' || doc_id // 100 AS book, a, regexp_replace(regexp_replace(CASE WHEN doc_id % 5 = 0 AND a = 0 THEN '漢' ELSE '' END || line, '{_UWS}+', ' ', 'g'), '^ | $', '', 'g') AS t FROM ({_LINES})),
j AS (SELECT *, NOT (length(t) < 2 OR regexp_matches(t, '(?i)(FullName|mso-|MsoNormal|st1:|\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:|false false|behavior:url)') OR NOT regexp_matches(t, '[\p{{L}}\p{{M}}\p{{N}}_]')) AS good FROM l),
c AS (SELECT book, lang, doc_id, coalesce(sum(length(t)) FILTER (WHERE good), 0)::BIGINT AS char_count, count(*) FILTER (WHERE good) AS paras, count(*) FILTER (WHERE t <> '') >= 3 AS titled,
 sha256(coalesce(string_agg(t, chr(10) ORDER BY a) FILTER (WHERE good), '')) AS texts,
 sha256(coalesce(string_agg(CASE WHEN doc_id % 5 = 0 AND a = 0 THEN '漢[かん]' || substr(t, 2) ELSE t END, chr(10) ORDER BY a) FILTER (WHERE good), '')) AS annots FROM j GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY doc_id)::INTEGER AS chapter_idx FROM c WHERE char_count >= 80),
b AS (SELECT book, any_value(lang) AS lang, bool_or(doc_id % 5 = 0) AS has_ruby FROM c GROUP BY book)"""


def _corpus(spark, sf_dir) -> DataFrame:
    """Documents as e-books of up to a hundred chapters, written as files and scanned."""
    lang = F.when(F.col("lang") == "en", "ko").when(F.col("lang") == "de", "ja").when(F.col("lang") == "fr", "th").otherwise("vi")
    docs = read(spark, sf_dir, "documents").withColumn("book", F.concat_ws("-", "lang", "source", F.expr("doc_id div 100")))
    books = docs.select("book", "lang", "doc_id", "text").repartition("book").sortWithinPartitions("book", "doc_id").mapInArrow(_books, "name string, value binary")
    old, new = F.split_part("name", F.lit("/"), F.lit(1)), F.split_part("name", F.lit("/"), F.lit(2))
    lang = F.when(old == "en", "ko").when(old == "de", "ja").when(old == "fr", "th").otherwise("vi")
    root = storage.work_path(spark, "corpus", make=True)
    sinks.write_files(books.select(F.concat(lang, F.lit("/"), new).alias("name"), "value"), root).count()
    return files.scan_corpus(spark, root)


@query(f"SELECT {_LANG} AS lang, lang || '-' || source || '-' || doc_id // 100 || '.epub' AS file, true AS hashed FROM documents GROUP BY ALL")
def scan_corpus(spark, sf_dir):
    """E-book files by language, with the hash of their content (sha256_file)."""
    found = _corpus(spark, sf_dir)
    return found.select("lang", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), (F.col("sha256") == F.sha2("content", 256)).alias("hashed"))


def _unpacked(spark, sf_dir):
    found = _corpus(spark, sf_dir)
    return files.scan_epub(found.select(F.regexp_extract("path", r"([^/]+)\.epub$", 1).alias("book_id"), F.lit("none").alias("title_orig"), "content"))


@query(f"""WITH {_BOOKS_SQL} SELECT b.book AS book_id, b.book AS title_orig, b.has_ruby, 'unpacked' AS status, chapter_idx, CASE WHEN titled THEN 'T ' || doc_id END AS title, char_count, paras, texts, annots
FROM b LEFT JOIN k ON k.book = b.book""")
def scan_epub(spark, sf_dir):
    rows = _unpacked(spark, sf_dir)
    joined = lambda c: F.when(F.col("chapter_idx").isNotNull(), F.sha2(F.array_join(F.transform("paras", lambda p: p[c]), "\n"), 256))
    return rows.select("book_id", "title_orig", "has_ruby", "status", "chapter_idx", "title", "char_count", F.when(F.col("chapter_idx").isNotNull(), F.size("paras")).cast("long").alias("paras"), joined("text").alias("texts"), joined("annot").alias("annots"))


@query("SELECT DISTINCT lang || '-' || source || '-' || doc_id // 100 AS book_id, CASE lang WHEN 'de' THEN 'vertical' ELSE 'horizontal' END AS script FROM documents")
def read_vertical(spark, sf_dir):
    return _unpacked(spark, sf_dir).select("book_id", "script").distinct()


@query(f"WITH {_BOOKS_SQL} SELECT doc_id, paras, texts, annots FROM c")
def walk_segments(spark, sf_dir):
    """Paragraphs, ruby and segments of pages made from whole documents (paragraphs, ruby_segment)."""
    from lexiforge.functions.html import document

    line = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    ruby = F.when(F.col("doc_id") % 5 == 0, "<ruby>漢<rp>(</rp><rt>かん</rt><rp>)</rp></ruby>").otherwise("")
    body = F.array_join(F.transform(F.split(line(F.col("text")), "\n"), lambda x: F.concat(F.lit("<p>"), x)), "")
    page = F.concat(F.lit("<style>p{}</style><p>"), ruby, F.substr(body, F.lit(4)), F.lit("<!-- end -->"))
    rows = read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", document(page)["paras"].alias("p"))
    joined = lambda c: F.sha2(F.array_join(F.transform("p", lambda x: x[c]), "\n"), 256)
    return rows.select("doc_id", F.size("p").cast("long").alias("paras"), joined("text").alias("texts"), joined("annot").alias("annots"))


@query("SELECT doc_id, sha256(text) AS text FROM documents")
def decode_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(decoded_text(F.encode("text", "UTF-8")), 256).alias("text"))


@query("SELECT doc_id, sha256('---' || chr(10) || 'id: ' || doc_id || chr(10) || 'level: ' || lang || chr(10) || 'status: draft' || chr(10) || '---' || chr(10) || chr(10) || regexp_replace(regexp_replace('```markdown' || chr(10) || text || chr(10) || '```', '^\\s*```(?:markdown|md)?\\s*\\n', ''), '\\n```\\s*$', '') || chr(10)) AS file FROM documents".replace("\\\\", "\\"))
def write_tutorial(spark, sf_dir):
    """Tutorials as Markdown files, written and read back."""
    root = storage.work_path(spark, "tutorials", make=True)
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("level"), F.lit("draft").alias("status"), F.concat(F.lit("```markdown\n"), "text", F.lit("\n```")).alias("body"))
    sinks.write_tutorials(rows, root)
    found = files.whole_files(spark, root, "*.md").select(F.regexp_extract("path", r"(\d+)\.md$", 1).cast("long").alias("doc_id"), "content")
    return found.select("doc_id", F.sha2("content", 256).alias("file"))


@query("""WITH g AS (SELECT lang AS language, count(*) AS n FROM documents GROUP BY lang)
SELECT language, language <> 'es' AND language <> 'fr' AS pushed, CASE language WHEN 'es' THEN 'incomplete' WHEN 'fr' THEN 'exists' ELSE 'pushed' END AS why, CASE WHEN language = 'es' THEN 0 ELSE n END AS rows FROM g""")
def push_enrich(spark, sf_dir):
    """Enriched files go out language by language: not where batches lack (es), nor over what is there (fr)."""
    docs = read(spark, sf_dir, "documents").select(F.col("lang").alias("language"), F.to_json(F.struct("doc_id")).alias("value"))
    source, target = storage.work_path(spark, "enriched"), storage.work_path(spark, "target", make=True)
    docs.write.partitionBy("language").text(source)
    docs.filter("language = 'fr'").write.mode("append").partitionBy("language").text(target)
    total = docs.groupBy("language").agg(F.count("*").alias("total"))
    gate = total.select("language", (F.col("total") - (F.col("language") == "es").cast("int")).alias("done"), "total", (F.col("language") != "es").alias("complete"))
    done = sinks.push_enrich(spark, gate, source, target)
    there = spark.read.text(target).groupBy("language").agg(F.count("*").alias("rows"))
    return done.join(there, "language", "left").select("language", "pushed", "why", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
