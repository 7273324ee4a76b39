"""Integrity of the knowledge base: queries that return violations (path, id, rule, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.functions import text as X


def _violations(rows: DataFrame, rules: dict) -> DataFrame:
    found = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(name).alias("rule"), detail.cast("string").alias("detail"))) for name, (ok, detail) in rules.items()]
    return rows.select("path", "id", F.explode(F.array_compact(F.array(*found))).alias("v")).select("path", "id", "v.*")


def field_rules(entries: DataFrame, grammar: bool = True) -> DataFrame:
    """Broken fields.  The level of a vocabulary entry isn't checked, nor an id's prefix against language or kind."""
    text = lambda e: X.strip(F.coalesce(e["text"], F.lit("")))
    lengths = F.transform("examples", lambda e: F.length(text(e)))
    rules = {
        "id": (F.col("id").rlike(schemas.ID_PATTERN), F.col("id")),
        "language": (F.col("language").isin(*schemas.LANGUAGES), F.col("language")),
        "status": (F.col("status").isin(*schemas.STATUSES), F.col("status")),
        "example_count": (F.size("examples") <= schemas.MAX_EXAMPLES, F.size("examples")),
        "example_empty": (~F.exists(lengths, lambda n: n == 0), F.lit("")),
        "example_length": (~F.exists(lengths, lambda n: n > schemas.MAX_EXAMPLE_CHARS), F.array_max(lengths)),
    }
    if grammar:
        legal = F.lit(False)
        for language, levels in schemas.LEVELS.items():
            legal = legal | ((F.col("language") == language) & F.col("level").isin(*levels))
        rules["type"] = (F.col("type").isin(*schemas.GRAMMAR_TYPES), F.col("type"))
        rules["level"] = (legal, F.col("level"))
        rules["level_rank"] = (~F.coalesce(legal, F.lit(False)) | (F.col("level_rank") == X.level_rank(F.col("level"))), F.col("level_rank"))
    return _violations(entries, rules)


def duplicate_ids(rows: DataFrame, order: str = "path") -> DataFrame:
    """Every occurrence of an id after its first."""
    place = F.row_number().over(W.partitionBy("id").orderBy(order))
    return rows.withColumn("__n", place).filter("__n > 1").select("path", "id", F.lit("duplicate_id").alias("rule"), F.col("id").alias("detail"))


def dangling_refs(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """References to ids that no entry has, one row per occurrence."""
    refs = F.concat("related.cross_lang", F.transform("related.same_lang", lambda r: r["id"]))
    rows = entries.select("path", "id", F.explode(refs).alias("ref"))
    return rows.join(ids.select(F.col("id").alias("ref")).distinct(), "ref", "left_anti").select("path", "id", F.lit("dangling_ref").alias("rule"), F.col("ref").alias("detail"))


def dangling_members(groups: DataFrame, ids: DataFrame) -> DataFrame:
    """Members of cross-language groups that no entry has."""
    rows = groups.select("path", F.col("group_id").alias("id"), F.explode("members").alias("language", "m")).select("path", "id", F.explode("m").alias("ref"))
    return rows.join(ids.select(F.col("id").alias("ref")).distinct(), "ref", "left_anti").select("path", "id", F.lit("dangling_member").alias("rule"), F.col("ref").alias("detail"))


def validate(grammar: DataFrame, vocab: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """All violations; ids and references count only entries without broken fields."""
    broken = [field_rules(grammar), field_rules(vocab, grammar=False)]
    good = [rows.join(bad.select("path").distinct(), "path", "left_anti") for rows, bad in zip((grammar, vocab), broken, strict=True)]
    slim = reduce(DataFrame.unionByName, [g.select("path", "id", "related") for g in good])
    found = [*broken, duplicate_ids(slim), dangling_refs(slim, slim)]
    if groups is not None:
        found.append(dangling_members(groups, slim))
    return reduce(DataFrame.unionByName, found)


def first_errors(violations: DataFrame, n: int = 50) -> DataFrame:
    return violations.orderBy("path", "id", "rule", "detail").limit(n)


def next_ids(entries: DataFrame, kind: str) -> DataFrame:
    """(language, next_id) for each language: one after the largest number."""
    number = F.regexp_extract("id", r"-(\d+)$", 1).cast("int")
    last = entries.filter(F.col("id").rlike(f"-{kind}-")).groupBy("language").agg(F.max(number).alias("last"))
    return last.select("language", F.format_string(f"%s-{kind}-%05d", "language", F.col("last") + 1).alias("next_id"))
