"""Adoption of extracted grammar points into the knowledge base, as one set-based plan.

Points are ordered by (file, position).  A point is kept with a legal level and at least one example that stands in its
source.  Points and entries with one (language, key) are a group: the entry, else the first point, owns it; the examples of
the others are appended in order while there is room and their text is new.  New ids follow the order of creation.

What is appended are the first texts, each at its first place, that the owner lacks, as many as there is room for: a minimum a
text and two rows a group, so that no group is gathered, and one of very many points (the empty key) is like any other.

Points whose level is out of the language's range go to the rejects unless their key has an owner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge import schemas, storage
from lexiforge.functions import text as X
from lexiforge.functions.annotate import annot_for_example
from lexiforge.functions.text import let
from lexiforge.operators.rank import numbered

EXAMPLES = "array<struct<text:string,reading:string,annot:string,translation_zh:string,source_book:string>>"


def points(files: DataFrame) -> DataFrame:
    """(path, language, book_id, chunk_text, points) to one row per point with its order."""
    return files.select("path", "language", "book_id", "chunk_text", F.posexplode("points").alias("pos", "p")).select("path", "pos", "language", "book_id", "chunk_text", "p.*")


def screened(rows: DataFrame, annotate: bool = True) -> DataFrame:
    """Points with level, level_rank, key and at most two examples that pass; others are left out."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    clean = F.transform(F.coalesce("examples", F.array().cast("array<struct<text:string,annot:string,reading:string,translation_zh:string>>")), lambda e: F.struct(X.strip(empty(e["text"])).alias("text"), X.strip(empty(e["annot"])).alias("annot"), X.strip(empty(e["reading"])).alias("reading"), X.strip(empty(e["translation_zh"])).alias("translation_zh")))
    rows = rows.withColumn("level", X.norm_level(F.col("language"), F.col("level"))).filter("level is not null")
    fits = lambda e: (e["text"] != "") & (F.length(e["text"]) <= schemas.MAX_EXAMPLE_CHARS)
    # the source is normalised once a point, not once an example
    kept = let(X.norm_for_match(empty(F.col("chunk_text"))), lambda source: F.filter(clean, lambda e: fits(e) & X.probe_in(e["text"], source)))
    rows = rows.withColumns({"key": X.dedup_key(F.col("structure_pattern"), F.col("structure"), F.col("title_zh")), "kept": F.slice(kept, 1, schemas.MAX_EXAMPLES)})
    rows = rows.filter(F.size("kept") > 0).withColumn("level_rank", X.level_rank(F.col("level")))
    one = lambda k: F.get("kept", F.lit(k))

    def done(k):
        own = X.valid_annot(one(k)["annot"], one(k)["text"])
        cut = annot_for_example(one(k)["text"], F.col("chunk_text")) if annotate else F.lit("")
        return F.when(one(k).isNotNull(), F.struct(one(k)["text"].alias("text"), one(k)["reading"].alias("reading"), F.when(own, one(k)["annot"]).otherwise(cut).alias("annot"), one(k)["translation_zh"].alias("translation_zh"), empty(F.col("book_id")).alias("source_book")))

    return rows.withColumn("examples", F.array_compact(F.array(*[done(k) for k in range(schemas.MAX_EXAMPLES)])).cast(EXAMPLES)).drop("kept")


@dataclass
class Adopted:
    """entries: (language, key, id, is_new, changed, examples, owner: the point's columns of a new one), those of the knowledge
    base and new ones; outcomes: (language, key, path, pos, id, outcome) of every point: created, merged, no-op or rejected."""

    entries: DataFrame
    outcomes: DataFrame


def adopt(kept: DataFrame, kb: DataFrame, dedup: bool = True) -> Adopted:
    """kept: screened points; kb: (path, language, id, key, examples) of stored entries; dedup: points of one key are one entry."""
    group = ["language", "key"] if dedup else ["language", "key", "path", "pos"]
    at = F.struct("path", "pos")
    own = F.struct("level", "level_rank", "title_zh", "structure", "structure_pattern", "explanation_zh", "tags", "frequency_hint", "book_id")
    points = storage.kept(kept.withColumns({"at": at, "own": own}), "screened")
    legal = F.when(F.col("level_rank").isNotNull(), F.col("at"))
    # without an entry the first legal point creates one; earlier ones are rejected
    first = points.groupBy(*group).agg(F.min(legal).alias("made"), F.min_by(F.struct("examples", "own"), legal).alias("owner"))
    if dedup:
        index = kb.groupBy("language", "key").agg(F.max_by(F.struct("id", "examples"), "path").alias("hit"))
        per = first.join(index, ["language", "key"], "full")
    else:
        per = first.withColumn("hit", F.lit(None).cast(f"struct<id:string,examples:{EXAMPLES}>"))
    none = F.array().cast(EXAMPLES)
    seed = F.when(F.col("hit").isNotNull(), F.coalesce("hit.examples", none)).otherwise(F.coalesce("owner.examples", none))
    per = per.select(*group, "made", F.col("hit.id").alias("old_id"), F.col("hit").isNotNull().alias("known"), seed.alias("seed"), F.col("owner.own").alias("own"))
    per = storage.kept(per.withColumn("is_new", ~F.col("known") & F.col("made").isNotNull()), "groups")
    room = schemas.MAX_EXAMPLES - F.size("seed")
    open_ = per.filter((room > 0) & (F.col("known") | F.col("is_new"))).select(*group, "made", "known", room.alias("room"), F.transform("seed", lambda e: X.squeeze(e["text"])).alias("have"))
    later = points.select(*group, "at", "examples").join(open_, group).filter(F.col("known") | (F.col("at") > F.col("made")))
    new = later.select(*group, "room", "have", F.posexplode("examples").alias("nth", "e"), "at").withColumn("text", X.squeeze(F.col("e.text")))
    new = new.filter((F.col("text") != "") & ~F.array_contains("have", F.col("text")))
    place = F.struct("at", "nth")
    new = new.groupBy(*group, "room", "text").agg(F.min(place).alias("place"), F.min_by("e", place).alias("e"))
    new = new.withColumn("n", F.row_number().over(W.partitionBy(*group).orderBy("place"))).filter(F.col("n") <= schemas.MAX_EXAMPLES).filter("n <= room")
    taken = new.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("n", F.col("place.at").alias("at"), "e"))).alias("taken"))
    per = per.join(taken, group, "left").withColumn("taken", F.coalesce("taken", F.array().cast(dict(taken.dtypes)["taken"])))
    ids = _new_ids(per.filter("is_new").select(*group, "made.path", "made.pos") if dedup else per.filter("is_new").select(*group), group, kb)
    per = storage.kept(per.join(ids, group, "left").withColumn("id", F.coalesce("old_id", "new_id")), "adopted")
    entries = per.filter("known or is_new").select("language", "key", "id", "is_new", (F.col("is_new") | (F.size("taken") > 0)).alias("changed"), F.concat("seed", F.transform("taken", lambda t: t["e"])).alias("examples"), F.when(F.col("is_new"), F.col("own")).alias("owner"))
    known = per.select(*group, "id", "known", "made", F.transform("taken", lambda t: t["at"]).alias("taken"))
    rows = points.select("language", "key", "path", "pos", "at").join(known, group)
    outcome = (
        F.when(~F.col("known") & (F.col("made").isNull() | (F.col("at") < F.col("made"))), "rejected").when(~F.col("known") & (F.col("at") == F.col("made")), "created")
        .when(F.array_contains("taken", F.col("at")), "merged").otherwise("no-op")
    )
    return Adopted(entries, rows.select("language", "key", "path", "pos", "id", outcome.alias("outcome")))


def _new_ids(new: DataFrame, group: list[str], kb: DataFrame) -> DataFrame:
    """(group..., new_id) of (group..., path, pos): numbers behind the language's last one, in order of creation."""
    last = kb.groupBy("language").agg(F.max(F.regexp_extract("id", r"-grm-(\d+)$", 1).cast("int")).alias("last"))
    rows = numbered(new, ["language"], ["path", "pos"], "place").join(last, "language", "left")
    return rows.select(*group, F.format_string("%s-grm-%05d", "language", F.coalesce("last", F.lit(0)) + F.col("place")).alias("new_id"))


def outcomes(adopted: Adopted) -> DataFrame:
    """(language, path, pos, id, outcome) per point."""
    return adopted.outcomes.select("language", "path", "pos", "id", "outcome")


def counts(adopted: Adopted) -> DataFrame:
    """(language, created, merged)."""
    return adopted.outcomes.groupBy("language").agg(F.count_if(F.col("outcome") == "created").alias("created"), F.count_if(F.col("outcome") == "merged").alias("merged"))


def kb_index(entries: DataFrame) -> DataFrame:
    """(path, language, id, key, examples) of grammar entries; an entry without a structure has the empty key."""
    key = X.dedup_key(F.col("structure_pattern"), F.col("structure"), F.lit(""))
    return entries.select("path", "language", "id", key.alias("key"), F.transform("examples", lambda e: F.struct(*[e[c].alias(c) for c in ("text", "reading", "annot", "translation_zh", "source_book")])).cast(EXAMPLES).alias("examples"))


def new_entries(adopted: Adopted, today: str, extracted_by: str) -> DataFrame:
    """The created entries in the knowledge base's form."""
    o = F.col("owner")
    empty = lambda c: X.strip(F.coalesce(c, F.lit("")))
    full = F.transform("examples", lambda e: F.struct(e["text"].alias("text"), e["reading"].alias("reading"), e["annot"].alias("annot"), e["translation_zh"].alias("translation_zh"), e["source_book"].alias("source_book"), F.lit(None).cast("int").alias("source_chapter"), F.lit(None).cast("map<string,string>").alias("pointer")))
    prov = F.struct(F.array(o["book_id"]).alias("discovered_in"), F.lit(True).alias("discovered_is_scalar"), F.lit(None).cast("int").alias("first_seen_chapter"), frequency_hint(o["frequency_hint"]).alias("frequency_hint"), F.lit(extracted_by).alias("extracted_by"), F.lit(today).alias("extracted_at"))
    related = F.struct(F.array().cast("array<string>").alias("cross_lang"), F.array().cast("array<struct<id:string,relation:string>>").alias("same_lang"))
    path = F.concat(F.lit("grammar/"), "language", F.lit("/"), "id", F.lit(".yaml"))
    return adopted.entries.filter("is_new").select(
        path.alias("path"), "id", "language", F.lit("grammar").alias("type"), o["level"].alias("level"), o["level_rank"].alias("level_rank"), empty(o["title_zh"]).alias("title"),
        empty(o["structure"]).alias("structure"), empty(o["structure_pattern"]).alias("structure_pattern"), empty(o["explanation_zh"]).alias("explanation_zh"), full.alias("examples"),
        related.alias("related"), F.coalesce(o["tags"], F.array().cast("array<string>")).alias("tags"), prov.alias("provenance"), F.lit("draft").alias("status"), F.lit("").alias("review_note"),
    )


def frequency_hint(raw):
    """raw: the JSON value as text; numbers become whole numbers, a quoted string becomes null."""
    return F.when(raw.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), F.expr("1").cast("int") * 0 + raw.try_cast("double").cast("int"))


def first_entries(entries: DataFrame, limit: int = 0, order: str = "path") -> DataFrame:
    """The first entries in order; 0: all of them."""
    return entries.orderBy(order).limit(limit) if limit else entries


def rewrite(entries: DataFrame, rewrites: DataFrame, most_tags: int = 5) -> DataFrame:
    """Entries with the rewritten title, structure, pattern, explanation and tags of rewrites (id, ...), where there are any."""
    new = rewrites.select("id", *[F.col(c).alias(f"__{c}") for c in ("title", "structure", "structure_pattern", "explanation_zh", "tags")])
    rows = entries.join(new, "id", "left").withColumn("__tags", F.slice("__tags", 1, most_tags))
    return rows.select(*[F.coalesce(f"__{c}", c).alias(c) if f"__{c}" in rows.columns else F.col(c) for c in entries.columns])


def annotate(entries: DataFrame, answers: DataFrame) -> DataFrame:
    """Entries with answered annotations (id, i, annot) where they fit their example; n_ok counts those."""
    given = answers.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("i", F.coalesce(X.strip(F.col("annot")), F.lit(""))))).alias("__a"))
    rows = entries.join(given, "id", "left").withColumn("__a", F.coalesce("__a", F.create_map().cast("map<int,string>")))
    got = lambda i: F.coalesce(F.try_element_at(F.col("__a"), i), F.lit(""))
    fits = lambda e, i: X.valid_annot(got(i), e["text"])
    examples = F.transform("examples", lambda e, i: F.when(fits(e, i), e.withField("annot", got(i))).otherwise(e))
    n_ok = F.size(F.filter(F.transform("examples", fits), lambda x: x)).cast("long")
    return rows.withColumns({"n_ok": n_ok, "examples": examples}).drop("__a")
