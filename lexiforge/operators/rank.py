"""Row numbers within groups without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge import storage

#: Rows that a task sorts, and parts at most.
RUN, PARTS = 500_000, 1024


def numbered(df: DataFrame, by: list[str], order: list[str], name: str, run: int | None = None) -> DataFrame:
    """df with `name`: 1, 2, ... within the groups `by` in ascending order of the columns `order` (nulls first, no ties).

    The rows are kept as a table, cut at keys of a bounded sample into parts of some `run` rows, and numbered within the parts;
    a part's offset is the sum of its group's parts before it.  Whatever the cuts are, the numbers are the same.
    """
    run = run or RUN
    df = storage.kept(df, "ranked")
    rows = df.count()
    parts = min(PARTS, -(-rows // run))
    if parts <= 1:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    keys = [*by, *order]
    share = max(1, rows // (64 * parts))
    sample = df.filter(F.pmod(F.xxhash64(*keys), F.lit(share)) == 0).select(*keys).sort(*keys).limit(256 * parts).collect()
    cuts = [sample[k * len(sample) // parts] for k in range(1, parts)] if sample else []
    lit = lambda row: F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in keys])
    part = _at_most([lit(c) for c in cuts], F.struct(*keys))
    df = df.withColumn("__part", part)
    counts = df.groupBy(*by, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    same = F.col("__part") == F.col("__p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    within = F.row_number().over(W.partitionBy(*by, "__part").orderBy(*order))
    return df.withColumn(name, within).join(counts, same).withColumn(name, (F.col(name) + F.col("__before")).cast("int")).select(*[c for c in df.columns if c != "__part"], name)


def _at_most(cuts: list[Column], key: Column) -> Column:
    """How many of the sorted cuts are <= key, by binary search."""
    if not cuts:
        return F.lit(0)
    step, steps = 1, []
    while step <= len(cuts):
        steps.insert(0, step)
        step *= 2
    table = F.array(*cuts)
    fits = lambda at, s: (at + s <= len(cuts)) & (F.get(table, at + s - 1) <= key)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(fits(at, s), s).otherwise(F.lit(0)))
