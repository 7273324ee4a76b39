"""What the site shows: sanitised entries, counts, pages, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.operators.rank import numbered


def visible(entries: DataFrame) -> DataFrame:
    """Entries but candidates and deprecated ones; a null status stays."""
    return entries.filter(~F.coalesce(F.col("status").isin("candidate", "deprecated"), F.lit(False)))


def sanitize(entries: DataFrame, books: DataFrame) -> DataFrame:
    """Visible entries with at most two examples, without pointers, texts cut, book ids as titles where known."""
    rows = visible(entries)
    titles = books.select("book_id", "title_orig").filter("title_orig is not null")
    used = rows.select("id", F.explode(F.array_distinct(F.transform(F.slice("examples", 1, schemas.MAX_EXAMPLES), lambda e: e["source_book"]))).alias("book_id"))
    names = used.join(titles, "book_id").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("book_id", "title_orig"))).alias("__names"))
    rows = rows.join(names, "id", "left").withColumn("__names", F.coalesce("__names", F.create_map().cast("map<string,string>")))
    name = lambda e: F.coalesce(F.try_element_at(F.col("__names"), F.coalesce(e["source_book"], F.lit(""))), e["source_book"])
    shown = lambda e: e.dropFields("pointer").withField("text", F.left(e["text"], F.lit(schemas.MAX_EXAMPLE_CHARS))).withField("source_book", name(e))
    return rows.withColumn("examples", F.transform(F.slice("examples", 1, schemas.MAX_EXAMPLES), shown)).drop("__names")


def first_examples(rows: DataFrame, key: str, order: str, text: str, most: int = schemas.MAX_EXAMPLES, cut: int = schemas.MAX_EXAMPLE_CHARS) -> DataFrame:
    """The same for examples that stand in rows: the first `most` per key, cut."""
    place = F.row_number().over(W.partitionBy(key).orderBy(order))
    return rows.withColumn("__n", place).filter(F.col("__n") <= most).drop("__n").withColumn(text, F.left(text, F.lit(cut)))


def language_counts(languages: DataFrame, **tables: DataFrame) -> DataFrame:
    """(language, <table>...) with a row for every language."""
    out = languages.select("language")
    for name, rows in tables.items():
        out = out.join(rows.groupBy("language").agg(F.count("*").alias(name)), "language", "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return out


def level_counts(entries: DataFrame) -> DataFrame:
    """(language, bucket, n): per level, and all."""
    sets = entries.groupingSets([["language", "level"], ["language"]], "language", "level").agg(F.count("*").alias("n"), F.grouping("level").alias("g"))
    return sets.select("language", F.when(F.col("g") == 1, "all").otherwise(F.col("level")).alias("bucket"), "n")


def pages(rows: DataFrame, order: list, size: int, bucket: Column | None = None, group: str = "language") -> DataFrame:
    """rows with (bucket, pos, page): every row also stands in the bucket `all`; pages of `size` rows."""
    b = F.explode(F.array(F.lit("all"), bucket)) if bucket is not None else F.lit("all")
    out = rows.withColumn("bucket", b)
    return numbered(out, [group, "bucket"], order, "pos").withColumn("page", F.ceil(F.col("pos") / size))


def page_counts(languages: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(language, items, pages): one page at least."""
    n = rows.groupBy("language").agg(F.count("*").alias("items"))
    out = languages.join(n, "language", "left").withColumn("items", F.coalesce("items", F.lit(0)).cast("long"))
    return out.select("language", "items", F.greatest(F.lit(1), F.ceil(F.col("items") / size)).alias("pages"))


def grouped_page(paged: DataFrame, item: str) -> DataFrame:
    """(language, bucket, page, level, items): a page's items by level, in page order."""
    rows = paged.groupBy("language", "bucket", "page", "level").agg(F.array_sort(F.collect_list(F.struct("pos", item))).alias("i"))
    return rows.select("language", "bucket", "page", "level", F.transform("i", lambda x: x[item]).alias("items"))


def pager_window(page: Column, total: Column, near: int = 2) -> Column:
    """The page numbers that a pager shows."""
    return F.filter(F.sequence(F.lit(1).cast("long"), F.greatest(total, F.lit(1)).cast("long")), lambda p: (p == 1) | (p == total) | (F.abs(p - page) <= near))


def related(entries: DataFrame, titles: DataFrame) -> DataFrame:
    """(id, cross, same): cross-language links with a title or null where it is to be added; same-language ones only with a title."""
    names = titles.select(F.col("id").alias("ref"), "title")
    cross = entries.select("id", F.posexplode("related.cross_lang").alias("o", "ref")).join(names, "ref", "left")
    same = entries.select("id", F.posexplode("related.same_lang").alias("o", "r")).select("id", "o", F.col("r.id").alias("ref"), F.col("r.relation").alias("relation")).join(names, "ref")
    listed = lambda df, name, *c: df.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("o", "ref", *c))).alias(name))
    rows = entries.select("id").join(listed(cross, "cross", "title"), "id", "left").join(listed(same, "same", "relation", "title"), "id", "left")
    drop = lambda c: F.transform(c, lambda x: x.dropFields("o"))
    return rows.select("id", drop("cross").alias("cross"), drop("same").alias("same"))


def with_tutorials(entries: DataFrame, tutorials: DataFrame) -> DataFrame:
    """entries with has_tutorial."""
    known = tutorials.select("id").distinct().withColumn("__t", F.lit(True))
    return entries.join(known, "id", "left").withColumn("has_tutorial", F.col("__t").isNotNull()).drop("__t")


def tutorial_levels(tutorials: DataFrame, entries: DataFrame) -> DataFrame:
    """tutorials with the level_rank of their entry, 0 where there is none."""
    ranks = entries.select("id", F.col("level_rank").alias("__r"))
    return tutorials.join(ranks, "id", "left").withColumn("level_rank", F.coalesce("__r", F.lit(0)).cast("int")).drop("__r")
