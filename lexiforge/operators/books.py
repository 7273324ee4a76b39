"""Books: registration by content hash, roll-ups, upserts and selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.operators.rank import numbered


def register(files: DataFrame, books: DataFrame, order: str = "ord") -> DataFrame:
    """files (lang, path, sha256, title, ord) into books (book_id, language, sha256, epub_path, ...): a known hash keeps its
    id and takes the last path, a new one gets the language's next id; two files with one hash are one book."""
    one = files.groupBy("sha256").agg(F.min_by("lang", order).alias("lang"), F.min_by("title", order).alias("title"), F.min(order).alias("first"), F.max_by("path", order).alias("path"))
    number = F.regexp_extract("book_id", r"^book-\w+-(\d+)$", 1)
    last = books.filter(number != "").groupBy(F.col("language").alias("lang")).agg(F.max(number.cast("int")).alias("last"))
    known = books.select("sha256", "book_id", F.col("language").alias("known_lang"), F.col("title_orig").alias("known_title"), F.col("epub_path").alias("known_path"))
    both = known.join(one, "sha256", "full")
    fresh = both.filter("book_id is null").join(last, "lang", "left")
    fresh = numbered(fresh, ["lang"], ["first"], "place")
    fresh = fresh.select(F.format_string("book-%s-%03d", "lang", F.coalesce("last", F.lit(0)) + F.col("place")).alias("book_id"), "lang", "title", "path", "sha256", F.lit(True).alias("is_new"))
    old = both.filter("book_id is not null").select("book_id", F.col("known_lang").alias("lang"), F.col("known_title").alias("title"), F.coalesce("path", "known_path").alias("path"), "sha256", F.lit(False).alias("is_new"))
    return old.unionByName(fresh).select("book_id", F.col("lang").alias("language"), F.col("title").alias("title_orig"), F.col("path").alias("epub_path"), "sha256", "is_new")


def rollup(chapters: DataFrame) -> DataFrame:
    """(book_id, chapter_count, total_chars, has_ruby) of chapters (book_id, char_count, has_ruby)."""
    return chapters.groupBy("book_id").agg(F.count("*").alias("chapter_count"), F.sum("char_count").alias("total_chars"), F.bool_or("has_ruby").alias("has_ruby"))


def dense_chapters(chapters: DataFrame, least: int) -> DataFrame:
    """Chapters of `least` characters or more, numbered densely from 1 in spine order."""
    kept = chapters.filter(F.col("char_count") >= least)
    return kept.withColumn("chapter_idx", F.row_number().over(W.partitionBy("book_id").orderBy("spine_pos")))


def upsert(books: DataFrame, updates: DataFrame, key: str = "book_id") -> DataFrame:
    """books with the columns of updates where updates has the key and a value."""
    new = [c for c in updates.columns if c != key]
    joined = books.join(updates.select(key, *[F.col(c).alias(f"__{c}") for c in new]), key, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in new else F.col(c) for c in books.columns])


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key: insert-or-replace."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("row"))
    return last.select("row.*")


def pending(books: DataFrame, language: str = "all", book: str | None = None) -> DataFrame:
    """Books that aren't unpacked yet; a missing status counts as pending."""
    rows = books.filter(~F.col("status").eqNullSafe("unpacked"))
    rows = rows if language == "all" else rows.filter(F.col("language") == language)
    return rows.filter(F.col("book_id") == book) if book else rows


def untokenized(books: DataFrame, tokens: DataFrame) -> DataFrame:
    return books.filter("status = 'unpacked'").join(tokens.select("book_id").distinct(), "book_id", "left_anti")


def status_histogram(books: DataFrame) -> DataFrame:
    return books.groupBy(F.coalesce("status", F.lit("?")).alias("status")).agg(F.count("*").alias("n"))


def with_title(rows: DataFrame, books: DataFrame, column: str) -> DataFrame:
    """rows with book ids replaced by titles where the book is known."""
    titles = books.select(F.col("book_id").alias("__book"), F.col("title_orig").alias("__title"))
    out = rows.join(titles, F.col(column) == F.col("__book"), "left")
    return out.withColumn(column, F.coalesce("__title", column)).drop("__book", "__title")
