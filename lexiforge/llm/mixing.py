"""Mixing sources to target weights by entropy balancing.

Targets are a water filling: sources share the total by weight, none above MOST times its own size.

Rates.  A document's rate is r = min(MOST, exp(tilt of its source + tilt of its length band)).  The rates minimise the relative
entropy sum(size * (r log r - r + 1)), measured per token, under one exact token constraint a source (its target) and one soft
constraint a length band (the band's share of all tokens stays what it was; RIDGE tells how soft).  The dual
sum(size * h(tilt)) - tilts . targets + ridge is convex; h is exp, and a line beyond log(MOST).  Both kinds of constraints meet
in every document, so the Hessian is coupled: each Newton step sums gradient and Hessian over the (source, band) cells on the
cluster, eliminates the sources (their block is diagonal) and solves the few bands on the driver; a step that doesn't lower the
dual is halved.  Steps end when every source constraint holds to TOLERANCE.

Rounding into whole copies: per source, documents are binned by size (exact below 64 words, then 64 bins an octave, so
at most some 2,600 bins a source whatever the input).  A fold from long to short gives each bin a number of copies and
carries the remainder to the next, shorter bin.  Inside a bin the copies left over go to the documents first in the order of
(hash, size, doc_id): a threshold, searched in one of sqrt(n) parts of the bin, so that no document is moved or ranked but those
of that part.  Documents that agree in all three share what falls on them row by row.

Defined results: null text has size 0; sources sort by code point, null last; documents of size 0 take 0; texts of any length
count whole; an empty table gives an empty result; a null or repeated doc_id is a document like others (of equal rows any may
take the copies, their number is fixed); other columns, whatever their names, don't matter and take_mix carries them along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.llm._shared import WORD, WS, fresh, let, read_table, sized_broadcast, stored, text_or_empty

WEIGHTS = (1, 2, 3)
MOST = 3
TOLERANCE = 1e-9
STEPS = 60
#: Length bands by octaves of the size: 1-3, 4-15, 16-63, 64-255, 256-1023 words and longer ones.
BANDS = 6
#: How soft the bands are: a tilt of 1 is worth this share of all tokens.
RIDGE = 0.02
#: A remainder above this share of the target may take any number of copies from 0 to MOST.
FAR = 0.005
EXACT_SIZES, PER_OCTAVE = 64, 64
LOG_MOST = math.log(MOST)
#: What WS matches.
SPACES = " \t\n\x0b\x0c\r"


def word_count(text_col: str) -> Column:
    """Words of a text, one letter each: regexp_count would hold a list of all words, several times the text, at once."""
    body = F.ltrim(text_or_empty(text_col), F.lit(SPACES))
    return F.length(F.regexp_replace(body, f"{WORD}{WS}*", "x")).cast("long")


def targets(cells: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """cells (source, words) to (source, source_size, target): one row per source; the windows run over sources only."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    own = cells.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn("weight", w.cast("long"))
    fill = W.orderBy((F.col("source_size") * most / F.col("weight")), F.col("source").asc_nulls_last())
    all_rows = W.partitionBy()
    own = own.withColumns({
        "total": F.sum("source_size").over(all_rows),
        "full": F.coalesce(F.sum(F.col("source_size") * most).over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "left": F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)),
    })
    level = (F.col("total") - F.col("full")) / F.col("left")
    own = own.withColumn("level", level).withColumn("open", F.col("source_size") * most / F.col("weight") >= F.col("level"))
    # the first open source has the largest weight left
    own = own.withColumn("water", F.max(F.when(F.col("open"), F.struct("left", "level"))).over(all_rows)["level"])
    target = F.least((F.col("source_size") * most).cast("double"), F.col("weight") * F.col("water"))
    return own.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _bin(size: Column) -> Column:
    octave = F.floor(F.log2(size.cast("double")))
    part = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * PER_OCTAVE)
    return F.when(size < EXACT_SIZES, size).otherwise(EXACT_SIZES + octave * PER_OCTAVE + part).cast("int")


def _band(bin_: Column) -> Column:
    octave = F.when(bin_ < EXACT_SIZES, F.floor(F.log2(bin_.cast("double")))).otherwise(F.floor((bin_ - EXACT_SIZES) / PER_OCTAVE))
    return F.least(F.floor(octave / 2), F.lit(BANDS - 1)).cast("int")


def tilts(cells: DataFrame, wanted: DataFrame, steps: int = STEPS, tolerance: float = TOLERANCE, ridge: float = RIDGE) -> tuple[DataFrame, list[float]]:
    """(source, source_size, target, tilt) and the tilts of the bands, by damped Newton steps on the dual.

    cells: (source, bin, words); wanted: targets().  Every step is one aggregation over (source, band) cells.
    """
    import numpy as np

    masses = cells.groupBy("source", _band(F.col("bin")).alias("band")).agg(F.sum("words").alias("words"))
    lists = masses.groupBy(F.col("source").alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("band", "words"))).alias("m"))
    mass = F.array(*[F.coalesce(F.try_element_at("m", F.lit(b)), F.lit(0)).cast("double") for b in range(BANDS)])
    # a source at its cap starts beyond it, others where their own constraint holds without bands
    start = F.when(F.col("target") >= MOST * F.col("source_size"), LOG_MOST + 1.0).otherwise(F.log(F.col("target") / F.col("source_size")))
    state = wanted.filter("target > 0").join(lists, F.col("source").eqNullSafe(F.col("s"))).select("source", "source_size", "target", mass.alias("mass"), start.alias("tilt"))
    state, bands = stored(state, "tilt-0"), np.zeros(BANDS)
    whole = state.agg(*[F.sum(F.col("mass")[b]).alias(f"m{b}") for b in range(BANDS)], F.count("*").alias("n")).first()
    keep = np.array([whole[b] or 0.0 for b in range(BANDS)])
    soft = ridge * max(1.0, keep.sum())
    if not whole["n"]:
        return state.drop("mass"), list(bands)

    def measured(rows: DataFrame, bands) -> DataFrame:
        """rows with t (tokens taken by band), c (those below the cap: the curvature), f (their part of the dual)."""
        at = lambda b: F.col("tilt") + float(bands[b])
        free = lambda b: at(b) <= LOG_MOST
        taken = F.array(*[F.col("mass")[b] * F.when(free(b), F.exp(at(b))).otherwise(float(MOST)) for b in range(BANDS)])
        curve = F.array(*[F.col("mass")[b] * F.when(free(b), F.exp(at(b))).otherwise(0.0) for b in range(BANDS)])
        dual = sum((F.col("mass")[b] * F.when(free(b), F.exp(at(b))).otherwise(MOST + MOST * (at(b) - LOG_MOST)) for b in range(BANDS)), -F.col("tilt") * F.col("target"))
        total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return rows.withColumns({"t": taken, "c": curve, "f": dual}).withColumns({"g": F.col("target") - total("t"), "h": total("c")})

    def summed(rows: DataFrame) -> dict:
        """Dual, worst miss, and the bands' gradient and Hessian with the sources eliminated."""
        share = lambda c, d: F.when(F.col("h") > 0, F.col("c")[c] * F.col("c")[d] / F.col("h")).otherwise(0.0)
        sums = [F.sum("f").alias("f"), F.max(F.abs(F.col("g")) / F.col("target")).alias("worst")]
        sums += [F.sum(F.col("t")[b] + F.when(F.col("h") > 0, F.col("c")[b] * F.col("g") / F.col("h")).otherwise(0.0)).alias(f"g{b}") for b in range(BANDS)]
        sums += [F.sum(F.col("c")[b]).alias(f"c{b}") for b in range(BANDS)] + [F.sum(share(b, d)).alias(f"h{b}_{d}") for b in range(BANDS) for d in range(b + 1)]
        return rows.agg(*sums).first().asDict()

    found = summed(measured(state, bands))
    value = lambda x, b: x["f"] - b @ keep + soft / 2 * b @ b
    for step in range(1, steps + 1):
        gradient = keep - soft * bands - np.array([found[f"g{b}"] for b in range(BANDS)])
        if found["worst"] <= tolerance and np.abs(gradient).max() <= 1e-6 * keep.sum():
            break
        hessian = np.diag([found[f"c{b}"] + soft for b in range(BANDS)])
        for b in range(BANDS):
            for d in range(b + 1):
                hessian[b, d] -= found[f"h{b}_{d}"]
                hessian[d, b] = hessian[b, d]
        move = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        shared = sum((F.col("c")[b] * float(move[b]) for b in range(BANDS)), F.lit(0.0))
        # a source below its target with all bands at the cap has no curvature and needs no step
        own = F.when(F.col("h") > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("g") - shared) / F.col("h")))).otherwise(0.0)
        moved = stored(measured(state, bands).select("source", "source_size", "target", "mass", "tilt", own.alias("move")), f"tilt-{step}")
        length = 1.0
        while True:
            trial = moved.withColumn("tilt", F.col("tilt") + length * F.col("move")).drop("move")
            now, at = summed(measured(trial, bands + length * move)), bands + length * move
            if value(now, at) <= value(found, bands) + 1e-9 * abs(value(found, bands)) or length < 1e-3:
                break
            length /= 2
        state, bands, found = trial, at, now
    return state.drop("mass"), [float(b) for b in bands]


def _fold(cells: Column, target: Column) -> Column:
    """cells: (bin, docs, words, rate) from long to short; returns (bin, docs, copies) with the remainder carried along."""
    mean = lambda c: c["words"] / c["docs"]
    want = lambda acc, c: c["rate"] * c["words"] + acc["carry"]

    def step(acc, c):
        def put(n):
            new = F.struct(c["bin"].alias("bin"), c["docs"].alias("docs"), n.alias("copies"))
            return F.struct((want(acc, c) - n * mean(c)).alias("carry"), F.concat(acc["out"], F.array(new)).alias("out"))

        # copies stay next to the rate; only a large remainder may move them further
        far = F.abs(acc["carry"]) > FAR * target
        least = F.when(far, 0).otherwise(F.floor(c["rate"])) * c["docs"]
        most = F.when(far, MOST).otherwise(F.least(F.ceil(c["rate"]), F.lit(MOST))) * c["docs"]
        n = F.greatest(least, F.least(F.floor(want(acc, c) / mean(c) + 0.5), most)).cast("long")
        return let(n, put)

    zero = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<struct<bin:int,docs:bigint,copies:bigint>>").alias("out"))
    return F.aggregate(cells, zero, step, lambda acc: acc["out"])


def _copies(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sized: a stored table (row: a key of its own, doc_id, source, size).

    Returns sized with copies, and (source, source_size, target).
    """
    sized = sized.withColumns({"bin": F.when(F.col("size") > 0, _bin(F.col("size"))), "mix": F.shiftrightunsigned(F.xxhash64("doc_id", "size"), 1)})
    counted = stored(sized.groupBy("source", "bin").agg(F.count("*").alias("docs"), F.sum("size").alias("words")), "counted")
    wanted = stored(targets(counted), "targets")
    cells = counted.filter("bin is not null")
    state, bands = tilts(cells, wanted)
    rate = F.least(F.exp(F.col("tilt") + F.element_at(F.array(*map(F.lit, bands)), _band(F.col("bin")) + 1)), F.lit(float(MOST)))
    rated = cells.join(sized_broadcast(state.select(F.col("source").alias("s"), "target", "tilt"), wanted.count()), F.col("source").eqNullSafe(F.col("s")))
    lists = rated.groupBy("source", "target").agg(F.sort_array(F.collect_list(F.struct("bin", "docs", "words", rate.alias("rate"))), asc=False).alias("cells"))
    dealt = lists.select(F.col("source").alias("s"), F.explode(_fold(F.col("cells"), F.col("target"))).alias("c"))
    dealt = dealt.select("s", F.col("c.bin").alias("b"), "c.docs", F.expr("c.copies div c.docs").alias("base"), F.expr("c.copies % c.docs").alias("extra"))
    dealt = stored(dealt, "dealt")
    here = F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    few = lambda df: sized_broadcast(df, df.count(), 100_000)
    # the threshold of a bin lies in one of its sqrt(docs) parts by hash
    parts = F.ceil(F.sqrt("docs")).cast("long")
    part = F.shiftright(F.shiftright("mix", 32) * F.col("parts"), 31)
    split = few(stored(dealt.filter("extra > 0").select("s", "b", "extra", parts.alias("parts")), "split"))
    ahead = lambda by, *order: F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sized.join(split, here).groupBy("s", "b", "extra", "parts", part.alias("part")).agg(F.count("*").alias("n"))
    sums = sums.withColumn("ahead", ahead(["s", "b"], "part")).filter("ahead < extra and extra <= ahead + n")
    inside = few(stored(sums.select("s", "b", "parts", F.col("part").alias("p"), (F.col("extra") - F.col("ahead")).alias("need")), "inside"))
    units = sized.join(inside, here & (part == F.col("p"))).groupBy("s", "b", "need", "mix", "size", "doc_id").agg(F.count("*").alias("n"))
    units = units.withColumn("ahead", ahead(["s", "b"], "mix", "size", "doc_id")).filter("ahead < need and need <= ahead + n")
    units = units.select(F.col("s").alias("us"), F.col("b").alias("ub"), F.struct("mix", "size", "doc_id").alias("last"), F.expr("need - ahead").alias("some"), F.col("n").alias("equal"))
    cuts = stored(dealt.join(units, F.col("s").eqNullSafe(F.col("us")) & (F.col("b") == F.col("ub")), "left").drop("us", "ub"), "cuts")
    own = F.struct("mix", "size", "doc_id")
    placed = sized.join(few(cuts), here, "left")
    extra = F.when(own < F.col("last"), 1).when(own.eqNullSafe(F.col("last")), F.when(F.col("some") == F.col("equal"), 1).otherwise(-1)).otherwise(0)
    placed = placed.withColumn("more", F.when(F.col("last").isNotNull(), extra).otherwise(0))
    copies = (F.coalesce("base", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("long")
    if cuts.filter("some < equal").limit(1).count():
        # equal rows of which only some take a copy more: numbered by the part of the table that they stand in
        open_ = placed.filter("more = -1").select("row", "s", "b", "some", F.shiftright("row", 33).alias("at"))
        open_ = stored(open_, "open")
        runs = open_.groupBy("s", "b", "at").agg(F.count("*").alias("n")).withColumn("ahead", ahead(["s", "b"], "at"))
        runs = runs.select(F.col("s").alias("us"), F.col("b").alias("ub"), F.col("at").alias("u"), "ahead")
        nth = F.row_number().over(W.partitionBy("s", "b", "at").orderBy("row"))
        numbered = open_.withColumn("nth", nth).join(few(stored(runs, "runs")), F.col("s").eqNullSafe(F.col("us")) & (F.col("b") == F.col("ub")) & (F.col("at") == F.col("u")))
        taking = numbered.select(F.col("row").alias("open"), (F.col("nth") + F.col("ahead") <= F.col("some")).alias("takes"))
        placed = placed.join(taking, F.col("row") == F.col("open"), "left").withColumn("more", F.when(F.col("more") == -1, F.col("takes").cast("int")).otherwise(F.col("more")))
    return placed.select("row", "doc_id", "source", "size", copies.alias("copies")), wanted


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, copies, taken); taken = copies * size."""
    sized = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    dealt, wanted = _copies(stored(sized, "sizes"))
    of = sized_broadcast(wanted.withColumnRenamed("source", "s"), wanted.count())
    out = dealt.join(of, F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs as the mix takes them: a document with k copies stands there k times (none: it is left out)."""
    own, row, key, times = docs.columns, *fresh(docs, "row", "key", "times")
    ids = docs.agg(F.count("*"), F.count(id_col), F.countDistinct(id_col)).first()
    if len(set(ids)) > 1:  # a key for each row needs rows that stay as they are
        docs = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        at = F.col(row)
    else:
        at = F.col(id_col)
    sized = docs.select(at.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    dealt = stored(_copies(stored(sized, "sizes"))[0].select(F.col("row").alias(key), F.col("copies").cast("int").alias(times)).filter("copies <> 1"), "mix")
    out = docs.join(sized_broadcast(dealt, dealt.count()), at == F.col(key), "left").withColumn(times, F.coalesce(times, F.lit(1)))
    return out.filter(F.col(times) > 0).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*own)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
