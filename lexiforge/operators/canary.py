"""Leak detection: short fragments of source texts must not stand in what is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge import storage
from lexiforge.schemas import CANARY_CHARS

BLOCK, WIDE = 8, 16
#: Rows (id, block) that are broadcast at most.
LIGHT = 400_000
#: First signs of needles that a pattern lists at most; with more any sign may be one.
FIRSTS = 200


def pick(paragraphs: DataFrame, chapters: tuple = (3, 2, 1), least: int = 50, most: int = 200, skip: int = 10) -> DataFrame:
    """(book_id, canary): of the first chapter in order of preference, the first paragraph of fitting length without blanks."""
    text = F.replace("text", F.lit(" "), F.lit(""))
    want = F.array_position(F.array(*[F.lit(c) for c in chapters]), F.col("chapter_idx").cast("int"))
    rows = paragraphs.withColumns({"t": text, "o": want}).filter((F.col("o") > 0) & F.length("t").between(least, most))
    best = rows.groupBy("book_id").agg(F.min_by("t", F.struct("o", "para_idx")).alias("t"))
    return best.select("book_id", F.substring("t", skip + 1, CANARY_CHARS).alias("canary"))


def probes(canaries: DataFrame) -> DataFrame:
    """(book_id, probe): the whole fragment and two parts of 20, so that cut copies count too."""
    parts = F.array(F.col("canary"), F.substring("canary", 1, 20), F.substring("canary", 11, 20))
    return canaries.select("book_id", F.explode(F.array_distinct(parts)).alias("probe")).filter("probe <> ''")


def containment(texts: DataFrame, needles: DataFrame, text: str = "text", probe: str = "probe") -> DataFrame:
    """texts joined with needles that stand in them, exactly, without comparing all pairs; repeated rows stay rows of their own."""
    texts = storage.kept(texts.withColumn("__row", F.monotonically_increasing_id()), "texts")
    needles = storage.kept(needles.withColumn("__needle", F.monotonically_increasing_id()), "needles")
    found = meetings(texts, needles, text, probe).join(needles, "__needle").join(texts, "__row").filter(F.contains(text, probe))
    return found.select(*texts.columns, *needles.columns).drop("__needle", "__row")


def meetings(texts: DataFrame, needles: DataFrame, text: str, probe: str) -> DataFrame:
    """(__row, __needle) of texts and needles, once each, that may hold one another: none that does is missing.

    A needle of 2 * wide - 1 code points or more covers a whole aligned block of `wide` of any text that holds it, and that
    block starts within the needle's first `wide` places: aligned blocks of texts meet those of needles in an equi-join on narrow
    rows (row, block).  Long needles take the rarer, WIDE blocks, others those of BLOCK.  A shorter needle that has BLOCK code
    points meets the blocks at every place of the texts where a needle may begin; still shorter ones, few as they are, are compared with every text.
    Blocks of few needles are broadcast, so that the texts' blocks aren't shuffled.
    """
    size, pairs = F.length(probe), None
    add = lambda some, more: more if some is None else some.unionByName(more)
    for wide, fits in ((WIDE, size >= 2 * WIDE - 1), (BLOCK, size.between(2 * BLOCK - 1, 2 * WIDE - 2))):
        starts = F.transform(F.sequence(F.lit(1), F.lit(wide)), lambda i: F.substring(F.col(probe), i, F.lit(wide)))  # noqa: B023
        own = needles.filter(fits).select("__needle", F.explode(F.array_distinct(starts)).alias("__block"))
        if own.limit(1).count():
            aligned = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s).{%d}" % wide), F.lit(0)))
            pairs = add(pairs, texts.select("__row", F.explode(aligned).alias("__block")).join(_light(own), "__block").select("__row", "__needle"))
    middle = needles.filter(size.between(BLOCK, 2 * BLOCK - 2)).select("__needle", F.left(probe, F.lit(BLOCK)).alias("__block"))
    if middle.limit(1).count():
        firsts = [r[0] for r in middle.select(F.ascii(F.left("__block", F.lit(1)))).distinct().limit(FIRSTS + 1).collect()]
        sign = "[" + "".join(r"\x{%x}" % c for c in sorted(firsts)) + "]" if len(firsts) <= FIRSTS else "."
        places = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(%s.{%d}))" % (sign, BLOCK - 1)), F.lit(1)))  # a substring by place would walk the text each time
        pairs = add(pairs, texts.filter(F.length(text) >= BLOCK).select("__row", F.explode(places).alias("__block")).join(_light(middle), "__block").select("__row", "__needle"))
    short = needles.filter(size < BLOCK)
    if short.limit(1).count():
        pairs = add(pairs, texts.join(short.select("__needle", probe), F.contains(F.col(text), F.col(probe))).select("__row", "__needle"))
    if pairs is None:
        pairs = texts.select("__row").join(needles.filter(F.lit(False)).select("__needle", F.col("__needle").alias("__row")), "__row")
    return pairs.distinct()


def _light(own: DataFrame) -> DataFrame:
    """own, to be broadcast if it has few rows."""
    return F.broadcast(own) if own.limit(LIGHT + 1).count() <= LIGHT else own


def leaks(published: DataFrame, canaries: DataFrame) -> DataFrame:
    """(book_id): each book of which any probe stands in any published text, once."""
    return containment(published.select("text"), probes(canaries)).select("book_id").distinct()
