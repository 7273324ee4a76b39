"""Gloss batches and vocabulary entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.functions import text as X
from lexiforge.operators.rank import numbered


def batches(words: DataFrame, size: int = schemas.GLOSS_BATCH, order: str = "rank") -> DataFrame:
    """(language, start, words): slices of `size` words in order, by their offset."""
    rows = numbered(words.select("language", "key", order), ["language"], [order], "place").withColumn("place", F.col("place") - 1)
    rows = rows.drop(order).withColumn("start", F.expr(f"cast(place div {size} * {size} as bigint)"))
    per = rows.groupBy("language", "start").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("w"))
    return per.select("language", "start", F.transform("w", lambda x: x["key"]).alias("words"))


def completeness(tasks: DataFrame, freq: DataFrame, stage: str, executor: str, size: int = schemas.GLOSS_BATCH) -> DataFrame:
    """(language, done, total, complete): tasks named <language>#<start> against the batches that the words need."""
    done = tasks.filter((F.col("stage") == stage) & (F.col("status") == "done") & (F.col("executor") == executor))
    done = done.groupBy(F.regexp_extract("item_key", "^([^#]+)#", 1).alias("language")).agg(F.count("*").alias("done"))
    total = freq.groupBy("language").agg(F.ceil(F.count("*") / size).alias("total"))
    rows = total.join(done, "language", "left").withColumn("done", F.coalesce("done", F.lit(0)).cast("long"))
    return rows.select("language", "done", "total", (F.col("done") >= F.col("total")).alias("complete"))


def lemma_artifact(word) -> F.Column:
    return F.contains(word, F.lit("-")) | F.contains(word, F.lit("代名词"))


def first_gloss(gloss: DataFrame) -> DataFrame:
    """One gloss per (language, word): the first by file and place."""
    first = gloss.groupBy("language", "word").agg(F.min_by(F.struct("gloss_zh", "pos", "hanja"), F.struct("file", "item")).alias("g"))
    return first.select("language", "word", "g.*")


def by_word(freq: DataFrame) -> DataFrame:
    """One row per word: of homographs with several readings the last, rarest one stands."""
    last = freq.groupBy("language", F.col("key").alias("word")).agg(F.max_by(F.struct("rank", "reading", "count", "doc_count"), "rank").alias("f"))
    return last.select("language", "word", "f.*")


def entries(freq: DataFrame, gloss: DataFrame, top: int = schemas.VOCAB_TOP) -> DataFrame:
    """Vocabulary entries of the words up to rank `top` that have a gloss; ids from ranks."""
    rows = by_word(freq).filter((F.col("rank") <= top) & ~lemma_artifact(F.col("word")))
    rows = rows.join(first_gloss(gloss), ["language", "word"])
    return rows.select(
        F.format_string("%s-voc-%05d", "language", "rank").alias("id"), "language", "word", F.when(F.col("language") == "ja", X.kata_to_hira(F.col("reading"))).otherwise("").alias("reading"),
        F.coalesce("pos", F.lit("")).alias("pos"), "gloss_zh", X.hanja_detail(F.col("hanja")).alias("gloss_detail_zh"),
        F.struct(F.col("rank").cast("int").alias("rank"), F.col("count").cast("int").alias("count"), F.col("doc_count").cast("int").alias("doc_count")).alias("frequency"), F.lit("draft").alias("status"),
    )
