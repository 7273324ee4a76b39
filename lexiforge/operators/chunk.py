"""Overlapping chunks of a book's paragraphs: an ordered fold per book, in the JVM for usual books, streaming for long ones."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiforge import schemas

_PARTS = "array<struct<ch:int,line:string>>"
_CHUNKS = "array<struct<from_chapter:int,to_chapter:int,char_count:bigint,text:string>>"


def fold(parts: Column, target: int, overlap: int) -> Column:
    """parts: array<struct<ch, line>> in order, to the array of chunks.  A chunk ends before the paragraph that would take
    it over the target, and its last `overlap` paragraphs open the next one; a single paragraph may exceed the target."""

    def done(s):
        last = F.element_at(s["cur"], -1)["ch"]
        text = F.array_join(F.transform(s["cur"], lambda x: x["line"]), "\n")
        return F.concat(s["out"], F.array(F.struct(s["from"].alias("from_chapter"), last.alias("to_chapter"), s["len"].alias("char_count"), text.alias("text"))))

    def step(s, p):
        n = F.length(p["line"]).cast("long")
        full = (F.size(s["cur"]) > 0) & (s["len"] + n > target)
        tail = F.slice(s["cur"], -F.least(F.lit(overlap), F.size(s["cur"])), F.lit(overlap)) if overlap else F.array().cast(_PARTS)
        tail_len = F.aggregate(tail, F.lit(0).cast("long"), lambda a, x: a + F.length(x["line"]))
        return F.struct(
            F.concat(F.when(full, tail).otherwise(s["cur"]), F.array(p)).alias("cur"),
            (F.when(full, tail_len).otherwise(s["len"]) + n).alias("len"),
            F.when(full, F.element_at(s["cur"], -1)["ch"]).otherwise(F.coalesce(s["from"], p["ch"])).alias("from"),
            F.when(full, done(s)).otherwise(s["out"]).alias("out"),
        )

    zero = F.struct(F.array().cast(_PARTS).alias("cur"), F.lit(0).cast("long").alias("len"), F.lit(None).cast("int").alias("from"), F.array().cast(_CHUNKS).alias("out"))
    return F.aggregate(parts, zero, step, lambda s: F.when(F.size(s["cur"]) > 0, done(s)).otherwise(s["out"]))


def chunks(paragraphs: DataFrame, target: int = schemas.CHUNK_TARGET, overlap: int = schemas.CHUNK_OVERLAP) -> DataFrame:
    """(book_id, chapter_idx, para_idx, text[, annot]) to chunks; JVM-side, for books of some thousand paragraphs."""
    line = F.coalesce(F.nullif("annot", F.lit("")), "text") if "annot" in paragraphs.columns else F.col("text")
    rows = paragraphs.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct(F.col("chapter_idx").alias("c"), F.col("para_idx").alias("a"), line.alias("line")))).alias("p"))
    parts = F.transform("p", lambda x: F.struct(x["c"].cast("int").alias("ch"), x["line"].alias("line")))
    rows = rows.select("book_id", F.posexplode(fold(parts, target, overlap)).alias("chunk_idx", "k"))
    return rows.select("book_id", "chunk_idx", "k.*")


def chunks_of_long_books(paragraphs: DataFrame, target: int = schemas.CHUNK_TARGET, overlap: int = schemas.CHUNK_OVERLAP) -> DataFrame:
    """The same for books of any length: paragraphs stream by in order, and no more than one chunk of them is held."""
    line = F.coalesce(F.nullif("annot", F.lit("")), "text") if "annot" in paragraphs.columns else F.col("text")
    rows = paragraphs.select("book_id", F.col("chapter_idx").cast("int").alias("ch"), "para_idx", line.alias("line"))
    kind = rows.schema["book_id"].dataType.simpleString()
    names = ["book_id", "chunk_idx", "from_chapter", "to_chapter", "char_count", "text"]

    def stream(batches):
        book, held, length, first, number, out = None, [], 0, None, 0, []

        def close():
            out.append((book, number, first, held[-1][0], length, "\n".join(t for _, t in held)))

        for batch in batches:
            for own, ch, text in zip(batch["book_id"], batch["ch"], batch["line"], strict=True):
                if held and own != book:
                    close()
                    held, length, first, number = [], 0, None, 0
                elif held and length + len(text) > target:
                    close()
                    first, number = held[-1][0], number + 1
                    held = held[-overlap:] if overlap else []
                    length = sum(len(t) for _, t in held)
                book, first = own, ch if first is None else first
                held.append((ch, text))
                length += len(text)
            if out:
                yield pd.DataFrame(out, columns=names)
                out.clear()
        if held:
            close()
            yield pd.DataFrame(out, columns=names)

    ordered = rows.repartition("book_id").sortWithinPartitions("book_id", "ch", "para_idx").select("book_id", "ch", "line")
    return ordered.mapInPandas(stream, f"book_id {kind}, chunk_idx int, from_chapter int, to_chapter int, char_count long, text string")


def tasks(chunked: DataFrame, version: str) -> DataFrame:
    """Extraction task ids: stage, book and the hash of version, index and the first 200 characters."""
    from lexiforge.functions.text import content_hash

    h = content_hash(F.lit(version), F.col("chunk_idx"), F.left("text", F.lit(200)))
    return chunked.select("book_id", "chunk_idx", F.concat(F.lit("s4_extract:"), F.col("book_id").cast("string"), F.lit(":"), h).alias("task_id"))


def window_of(chunked: DataFrame, start: int = 0, most: int = 5) -> DataFrame:
    """Chunks start..start+most-1 of each book."""
    return chunked.filter(F.col("chunk_idx").between(start, start + most - 1))


def prompts(chunked: DataFrame, template: str, version: str) -> DataFrame:
    """(task_id, book_id, chunk_idx, prompt): what an external model is asked about each chunk."""
    from lexiforge.functions.text import render

    ids = tasks(chunked, version)
    filled = render(template, book_id=F.col("book_id"), chunk_idx=F.col("chunk_idx"), text=F.col("text"))
    return chunked.join(ids, ["book_id", "chunk_idx"]).select("task_id", "book_id", "chunk_idx", filled.alias("prompt"))


def results(answers: DataFrame, asked: DataFrame) -> DataFrame:
    """(task_id, book_id, chunk_idx, json, error) of answers (task_id, text): the JSON of each, or why there is none."""
    from lexiforge.functions.annotate import extract_json

    rows = asked.select("task_id", "book_id", "chunk_idx").join(answers, "task_id", "left").withColumn("json", extract_json("text"))
    error = F.when(F.col("text").isNull(), "no answer").when(F.col("json").isNull(), "no JSON")
    return rows.select("task_id", "book_id", "chunk_idx", "json", error.alias("error"))
