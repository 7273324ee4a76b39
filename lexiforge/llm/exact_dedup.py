"""Exact dedup by a tree-merge of sorted digest runs.

Every scan partition yields a run: one row per digest with its smallest identifier and count.  Runs meet in rounds as in
a k-nomial tree (FAN_IN runs become one run per round); the minimum over a struct is a sort-based aggregate in Spark, so
that a round merges sorted runs, and it splits each merged run by digest over all partitions.  Then the winners go down
the same tree.  A join key is (node, digest) on every level, so a group of copies with a third of all rows has at most
FAN_IN rows per key above the leaves, and at the leaves as many as one scan partition holds.

A digest is SHA-256 with the byte length and an independent XXH64 of the same text: a group forms only where all three
agree, on every level.

Defined results: null text counts as empty; a null doc_id sorts after all others; of repeated rows (same doc_id and text)
exactly one is kept; texts of any length count whole; an empty table gives an empty result; other columns are ignored,
whatever their names (drop_copies carries them along).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import WS, fresh, read_table, sized_broadcast, stored, text_or_empty

FAN_IN = 8
DIGEST = ["digest", "check", "n_bytes"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: (doc_id, row_id, run, digest, check, n_bytes); the whole text is read once."""
    norm = F.regexp_replace(text_or_empty(text_col), WS + "+", " ")
    row_id = F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"), row_id.alias("row_id"))
    return rows.select(
        "doc_id", "row_id", F.shiftright("row_id", 33).alias("run"), F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.xxhash64("norm").alias("check"), F.octet_length("norm").alias("n_bytes"),
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256, row_id)."""
    rows = stored(digests(docs, id_col, text_col), "digests")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    run = rows.groupBy(F.col("run").alias("node"), *DIGEST).agg(F.min(first).alias("first"), F.count("*").alias("n"))
    tree = [stored(run, "run-0")]
    nodes = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while nodes > 1:
        node = F.expr(f"node div {fan_in}").alias("node")
        run = tree[-1].groupBy(node, *DIGEST).agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        tree.append(stored(run, f"run-{len(tree)}"))
        nodes = -(-nodes // fan_in)
    won = tree.pop().filter("n > 1")
    while tree:
        below = tree.pop().select(F.col("node").alias("child"), F.expr(f"node div {fan_in}").alias("node"), *DIGEST)
        won = won.join(below, ["node", *DIGEST]).select(F.col("child").alias("node"), *DIGEST, "first", "n")
    won = won.withColumnRenamed("node", "run")
    return rows.join(won, ["run", *DIGEST], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row_id") == F.col("row_id"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row_id",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all but the first row of each group of equal texts; columns as before.

    The first is the one with the smallest doc_id (null last); of rows with that doc_id and equal texts the one whose other
    columns come first in their order, so that reruns agree (of rows that agree in all columns any is that row).
    """
    own, key, sha, mark, text, rank = docs.columns, *fresh(docs, "key", "sha", "mark", "norm", "rank")
    found = stored(copies(docs, id_col, text_col), "copies")
    keys = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("any"), F.count("*").alias("times"))
    keys = stored(keys.filter("times > 1 or not any"), "copy-keys")
    digest = F.sha2(F.regexp_replace(text_or_empty(text_col), WS + "+", " "), 256)
    marks = sized_broadcast(keys.select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha), F.col("any").alias(mark)), keys.count(), 100_000)
    tagged = docs.withColumn(text, digest).join(marks, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(text) == F.col(sha)), "left")
    out = tagged.filter(F.col(mark).isNull()).select(*own)
    if keys.filter("any").limit(1).count():  # rows that stand in the table more than once: the least by all their columns
        again = tagged.filter(F.col(mark)).withColumn(rank, F.to_json(F.struct(*own)))
        least = again.groupBy(id_col, text).agg(F.min_by(F.struct(*own), F.col(rank)).alias(rank))
        out = out.unionByName(least.select(f"{rank}.*"))
    return out.select(*own)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
"""
