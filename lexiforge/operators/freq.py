"""Token and document frequencies with deterministic ranks, and vocabulary candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.functions.tokenizers import words
from lexiforge.operators.rank import numbered


def document_tokens(docs: DataFrame, language: str = "lang", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(language, book_id, ord, key): the native tokenizer over whole texts; ord is the place of the token in its book."""
    rows = docs.select(F.col(language).alias("language"), F.col(doc).alias("book_id"), F.posexplode(words(F.col(text))).alias("i", "key"))
    return rows.select("language", "book_id", F.col("i").alias("ord"), "key")


def token_freq(tokens: DataFrame, keys: tuple = ("key",)) -> DataFrame:
    """(language, rank, keys..., count, doc_count): ranks by falling count, ties by first occurrence (book, place in it).

    Counts go by (language, key, book) first, so that a document frequency needs no distinct set, and a frequent key is
    summed on the map side.
    """
    per_book = tokens.groupBy("language", *keys, "book_id").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))
    first = [F.min("book_id").alias("first_book"), F.min_by("first_ord", "book_id").alias("first_ord")]
    total = per_book.groupBy("language", *keys).agg(F.sum("n").alias("count"), F.count("*").alias("doc_count"), *first)
    return _ranked(total, keys)


def _ranked(total: DataFrame, keys: tuple) -> DataFrame:
    ranked = numbered(total.withColumn("falling", -F.col("count")), ["language"], ["falling", "first_book", "first_ord"], "rank")
    return ranked.select("language", "rank", *keys, "count", "doc_count")


def document_freq(docs: DataFrame, language: str = "lang", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """token_freq of document_tokens, without rows by document.

    A document's words go out twice: all of them, to be counted, and its distinct ones in order of their first places, for the
    document frequency and the first occurrence.  Both are summed by (language, key) on the map side.  Where an id has
    several texts, words go by document first.
    """
    if docs.groupBy(language, doc).count().filter("count > 1").limit(1).count():
        return token_freq(document_tokens(docs, language, doc, text))
    rows = docs.select(F.col(language).alias("language"), F.col(doc).alias("book_id"), words(F.col(text)).alias("w"))
    both = F.array(F.struct(F.lit(0).alias("own"), F.col("w").alias("w")), F.struct(F.lit(1).alias("own"), F.array_distinct("w").alias("w")))
    rows = rows.select("language", "book_id", F.explode(both).alias("x")).select("language", "book_id", "x.own", F.posexplode("x.w").alias("ord", "key"))
    book, place = (F.when(F.col("own") == 1, F.col(c)) for c in ("book_id", "ord"))
    total = rows.groupBy("language", "key").agg(F.sum(1 - F.col("own")).alias("count"), F.sum("own").alias("doc_count"), F.min(book).alias("first_book"), F.min_by(place, book).alias("first_ord"))
    return _ranked(total, ("key",))


def modal_value(rows: DataFrame, keys: list[str], value: str, order: str, out: str = "modal") -> DataFrame:
    """The most frequent non-empty value per key, ties to the one seen first; '' where there is none."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    full = F.coalesce(F.col(value), F.lit("")) != ""
    best = F.max_by(value, F.when(full, F.struct("n", -F.col("first"))))
    return counted.groupBy(*keys).agg(F.coalesce(best, F.lit("")).alias(out))


def candidates(freq: DataFrame, stopwords: DataFrame, min_count: int = schemas.MIN_COUNT, min_docs: int = schemas.MIN_DOCS, most: int = schemas.MAX_CANDIDATES) -> DataFrame:
    """Frequent keys of two letters or more that are no stopwords; ranks stay as they were."""
    kept = freq.filter((F.length("key") >= 2) & ((F.col("count") >= min_count) | (F.col("doc_count") >= min_docs)))
    stops = stopwords.select("language", F.col("word").alias("key"))
    kept = kept.join(stops, ["language", "key"], "left_anti")
    # a filter on a row number keeps at most `most` rows of a language in each task before the shuffle
    place = F.row_number().over(W.partitionBy("language").orderBy("rank"))
    return kept.withColumn("place", place).filter(F.col("place") <= most).drop("place")


def summary(freq: DataFrame, kept: DataFrame) -> DataFrame:
    """(language, types, candidates)."""
    types = freq.groupBy("language").agg(F.count("*").alias("types"))
    return types.join(kept.groupBy("language").agg(F.count("*").alias("n")), "language", "left").select("language", "types", F.coalesce("n", F.lit(0)).cast("long").alias("candidates"))
