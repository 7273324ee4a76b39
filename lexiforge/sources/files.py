"""Readers of the corpus and of intermediate files; explicit schemas, broken records kept out as the semantics ask."""

from __future__ import annotations

import fnmatch
import io
import os
import posixpath
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiforge import schemas, storage
from lexiforge.functions.decode import decoded
from lexiforge.functions.html import paragraphs_of, parse, title_of

LANGUAGE_ORDER = {lang: k for k, lang in enumerate(schemas.LANGUAGES)}
#: Documents whose name holds one of these are not chapters.
NOT_CHAPTERS = ("nav", "toc", "cover", "contents", "ads")


#: Bytes of files and characters of chapters that a worker holds at a time, some.
HELD = 4_000_000


def whole_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, content) of the files below root whose names fit.

    In a mounted folder workers list and read them, however many there are: Spark's own reader keeps the state of every file on the driver
    and has a task for every few dozens of small ones.  It reads other stores.
    """
    top = storage.local_path(root)
    if top is None or any(c in top for c in "*?[{"):
        return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root).select("path", "content")
    if not storage.exists(spark, root):
        raise FileNotFoundError(root)

    def names(batches):
        import pyarrow as pa

        for batch in batches:
            for one in batch.column(0).to_pylist():
                found = []
                for folder, below, own in os.walk(one):
                    below[:] = [d for d in below if d[0] not in "._"]
                    for name in own:
                        if name[0] not in "._" and fnmatch.fnmatchcase(name, pattern):
                            found.append(f"{folder}/{name}")
                            if len(found) == 10_000:
                                yield pa.RecordBatch.from_pydict({"path": found})
                                found = []
                yield pa.RecordBatch.from_pydict({"path": pa.array(found, pa.string())})

    def contents(batches):
        import pyarrow as pa

        for batch in batches:
            paths, held, size = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as f:
                    held.append(f.read())
                paths.append(f"file:{path}")
                size += len(held[-1])
                if size > HELD:
                    yield pa.RecordBatch.from_pydict({"path": paths, "content": held})
                    paths, held, size = [], [], 0
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "content": pa.array(held, pa.binary())})

    tasks = max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = spark.createDataFrame([(top.rstrip("/") or "/",)], "path string").mapInArrow(names, "path string")
    return found.repartition(tasks).mapInArrow(contents, "path string, content binary")


def scan_corpus(spark: SparkSession, root: str, language: str | None = None) -> DataFrame:
    """(lang, path, sha256, content, lang_ord) of root/<lang>/*.epub; their order is (lang_ord, path), contents aren't sorted."""
    files = whole_files(spark, root, "*.epub")
    lang = F.regexp_extract("path", r"/([^/]+)/[^/]+\.epub$", 1)
    order = F.create_map(*[F.lit(x) for pair in LANGUAGE_ORDER.items() for x in pair])
    rows = files.select(lang.alias("lang"), "path", F.sha2("content", 256).alias("sha256"), "content")
    rows = rows.filter(F.col("lang").isin(*([language] if language else schemas.LANGUAGES)))
    return rows.withColumn("lang_ord", F.try_element_at(order, F.col("lang")))


def read_epub(content: bytes) -> dict:
    """Title, writing direction and chapters of one e-book, in spine order; short and unreadable documents are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        local = lambda e: e.tag.rpartition("}")[2]
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        opf = next(e.get("full-path") for e in container.iter() if local(e) == "rootfile")
        package, base = ElementTree.fromstring(z.read(opf)), posixpath.dirname(opf)
        items = {e.get("id"): e for e in package.iter() if local(e) == "item"}
        place = lambda e: posixpath.normpath(posixpath.join(base, e.get("href") or ""))
        title = next((e.text for e in package.iter() if local(e) == "title" and e.text), None)
        styles = [e for e in items.values() if e.get("media-type") == "text/css"]
        names = set(z.namelist())
        vertical = any("vertical" in decoded(z.read(place(e))).lower() for e in styles if place(e) in names)
        chapters, ruby = [], False
        for ref in (e for e in package.iter() if local(e) == "itemref"):
            item = items.get(ref.get("idref"))
            if item is None or any(k in (item.get("href") or "").lower() for k in NOT_CHAPTERS) or place(item) not in names:
                continue
            try:
                root = parse(decoded(z.read(place(item))))
            except Exception:  # noqa: BLE001
                continue  # one unreadable document costs no more than itself
            ruby = ruby or any(n.name == "ruby" for n in root.walk())
            paras = paragraphs_of(root)
            chars = sum(len(p["text"]) for p in paras)
            if chars >= schemas.MIN_CHAPTER_CHARS:
                chapters.append({"chapter_idx": len(chapters) + 1, "title": title_of(root), "paras": paras, "char_count": chars})
    return {"title": title, "script": "vertical" if vertical else "horizontal", "has_ruby": ruby, "chapters": chapters}


_EPUB = "book_id string, title_orig string, script string, has_ruby boolean, status string, chapter_idx int, title string, paras array<struct<text:string,annot:string>>, char_count long"


def scan_epub(books: DataFrame) -> DataFrame:
    """(book_id, title_orig, content) to one row per chapter; a book without chapters or that can't be read has one row
    with null chapter_idx and status unpacked or failed_unpack."""

    kind = books.schema["book_id"].dataType.simpleString()

    def unpack(batches):
        import pyarrow as pa

        paras = pa.list_(pa.struct([("text", pa.string()), ("annot", pa.string())]))
        own = [pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.string(), paras, pa.int64()]

        def made(ids, rows):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), own, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, books_id), *columns], names=["book_id", "title_orig", "script", "has_ruby", "status", "chapter_idx", "title", "paras", "char_count"])

        for batch in batches:
            books_id, ids, rows, held = batch.column(0).type, [], [], 0
            for book_id, title, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    book = read_epub(content)
                    kept = [book["title"] or title, book["script"], book["has_ruby"], "unpacked"]
                    new = [(*kept, c["chapter_idx"], c["title"], c["paras"], c["char_count"]) for c in book["chapters"]] or [(*kept, None, None, None, None)]
                except Exception:  # noqa: BLE001
                    new = [(title, None, None, "failed_unpack", None, None, None, None)]
                ids += [book_id] * len(new)
                rows += new
                held += sum(r[-1] or 0 for r in new)
                if held > HELD:
                    yield made(ids, rows)
                    ids, rows, held = [], [], 0
            if rows:
                yield made(ids, rows)

    return books.select("book_id", "title_orig", "content").mapInArrow(unpack, _EPUB.replace("book_id string", f"book_id {kind}", 1))


def scan_chapters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHAPTER).json(path)


def scan_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TOKEN).json(path)


def explode_paragraphs(chapters: DataFrame) -> DataFrame:
    """One row per paragraph: (book_id, chapter_idx, para_idx, text, annot)."""
    rows = chapters.select("book_id", "chapter_idx", F.posexplode("paras").alias("para_idx", "p"))
    return rows.select("book_id", "chapter_idx", "para_idx", "p.text", "p.annot")


def scan_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """(language, word) of <language>.txt files: stripped lines, without blank ones and those that begin with #."""
    rows = spark.read.text(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("language"), "value")
    strip = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    return rows.filter(~F.startswith("value", F.lit("#"))).select("language", strip.alias("word")).filter("word <> ''").distinct()


def scan_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(path, book_id, chunk_idx, chunk_text, points) of candidate files, wrapped or bare; unreadable files are left out."""
    schema = T.StructType([*schemas.CANDIDATE.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = rows.withColumn("path", F.input_file_name()).filter("_corrupt is null")
    points = F.coalesce("result.grammar_points", "grammar_points", F.array().cast(f"array<{schemas.POINT.simpleString()}>"))
    points = F.transform(points, lambda p: p.withField("frequency_hint", F.to_json(p["frequency_hint"])))
    return rows.select("path", F.coalesce("book_id", F.lit("")).alias("book_id"), "chunk_idx", F.coalesce("chunk_text", F.lit("")).alias("chunk_text"), points.alias("points"))


def scan_chunk_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, chunk_text) of the candidate files that hold a text."""
    return scan_candidates(spark, path).filter("chunk_text <> ''").select("path", "chunk_text")


def scan_freq_tsv(spark: SparkSession, path: str) -> DataFrame:
    kinds = "rank int, key string, reading string, pos string, count long, doc_count long"
    return spark.read.schema(kinds).csv(path, sep="\t", header=True, quote="", nullValue=None, emptyValue="")


def scan_gloss(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos_in_file, word, gloss_zh, pos, hanja) of items with a word and a gloss."""
    kinds = "words array<string>, gloss array<struct<word:string,gloss_zh:string,pos:string,hanja:string>>"
    rows = spark.read.schema(kinds).option("multiLine", "true").json(path).select(F.input_file_name().alias("file"), F.posexplode("gloss").alias("item", "g"))
    return rows.select("file", "item", "g.*").filter("coalesce(word, '') <> '' and coalesce(gloss_zh, '') <> ''")


def _entry(path: str, raw: bytes, grammar: bool) -> dict | None:
    import yaml

    data = yaml.load(raw, getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    text = lambda x: None if x is None else str(x)
    examples = [{"text": e.get("text"), "reading": e.get("reading") or "", "annot": e.get("annot") or "", "translation_zh": e.get("translation_zh") or "", "source_book": e.get("source_book") or "", "source_chapter": e.get("source_chapter"), "pointer": {str(k): str(v) for k, v in e["pointer"].items()} if e.get("pointer") else None} for e in data.get("examples") or []]
    related, prov = data.get("related") or {}, data.get("provenance") or {}
    found = prov.get("discovered_in") or ""
    out = {
        "path": path, "id": data.get("id"), "language": data.get("language"), "type": data.get("type") or ("grammar" if grammar else "vocab"),
        "level": data.get("level") or "", "level_rank": data.get("level_rank") or 0, "examples": examples,
        "related": {"cross_lang": related.get("cross_lang") or [], "same_lang": [{"id": r.get("id"), "relation": r.get("relation") or "other"} for r in related.get("same_lang") or []]},
        "tags": data.get("tags") or [], "status": data.get("status") or "draft",
        "provenance": {"discovered_in": found if isinstance(found, list) else [found], "discovered_is_scalar": not isinstance(found, list), "first_seen_chapter": prov.get("first_seen_chapter"), "frequency_hint": prov.get("frequency_hint"), "extracted_by": text(prov.get("extracted_by")) or "", "extracted_at": text(prov.get("extracted_at")) or ""},
    }
    if grammar:
        return out | {k: data.get(k) or "" for k in ("title", "structure", "structure_pattern", "explanation_zh", "review_note")}
    freq = data.get("frequency") or {}
    return out | {k: data.get(k) or "" for k in ("word", "reading", "pos", "gloss_zh", "gloss_detail_zh")} | {"frequency": {k: freq.get(k) for k in ("rank", "count", "doc_count")}}


def scan_kb(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Entries of root/<kind>/<language>/*.yaml; kind: grammar or vocab.  Files that can't be parsed are left out."""
    grammar = kind == "grammar"
    schema = schemas.GRAMMAR if grammar else schemas.VOCAB
    files = whole_files(spark, f"{root}/{kind}", "*-grm-*.yaml" if grammar else "*-voc-*.yaml")

    def load(batches):
        import json

        import pandas as pd

        for batch in batches:
            out = []
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                try:
                    out.append(json.dumps(_entry(path, raw, grammar)))
                except Exception:  # noqa: BLE001
                    continue
            yield pd.DataFrame({"entry": pd.Series(out, dtype=str)})

    return files.mapInPandas(load, "entry string").select(F.from_json("entry", schema).alias("e")).select("e.*")


def scan_books(spark: SparkSession, path: str) -> DataFrame:
    """The list of books (one small YAML file) with its order; an absent file has none."""
    import yaml

    raw = spark.read.format("binaryFile").load(path).select("content").collect() if _exists(spark, path) else []
    rows = [tuple({**b, "book_ord": k}.get(f.name) for f in schemas.BOOK) for r in raw for k, b in enumerate(yaml.load(bytes(r[0]), getattr(yaml, "CSafeLoader", yaml.SafeLoader)) or [])]
    return spark.createDataFrame(rows, schemas.BOOK)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
