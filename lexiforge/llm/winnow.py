"""Document fingerprints by winnowing.

A text is cut into words (runs of non-space, pieces of at most PIECE code points where there is no space).  Each run of
GRAM words has a polynomial hash modulo 2^31 - 1 over word hashes; every window of WINDOW consecutive hashes selects its
minimum, the rightmost one on ties; (hash, word position) pairs are kept.  Any match of GRAM + WINDOW - 1 words or more
shares a selected hash.  A text with fewer than GRAM words has one gram, the hash of them all; an empty one has none.  The
units are the same for texts of every length, so that any two fingerprints compare.

A hash and its position are one long (hash * 2^31 + 2^31 - 1 - position), so that a minimum also breaks ties rightwards.
Window minima come by doubling: minima of two neighbours, then of two such minima a step apart.

The next document is found without a global window: exact quantiles of the ids cut them into buckets, each row goes to
its bucket, and the first row of a bucket also goes to the bucket before as a closing row.  Only texts are shuffled, once;
fingerprints are taken behind the shuffle.

Defined results: null text counts as empty; a null doc_id comes first; of repeated ids the order is by text digest (texts that
are equal too have equal results in any order); the only document of a table is its own successor; texts of any length are taken
whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.llm._shared import let, read_table, text_or_empty

GRAM, WINDOW, PIECE = 4, 4, 32
PRIME, BASE, SHIFT = 2_147_483_647, 1_000_003, 31
#: Buckets per shuffle partition for the search of the next document.
BUCKETS = 16


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The selected (hash, position) pairs of a text, in order of position, as array<bigint>."""
    hashed = lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]{1,%d}" % PIECE), F.lit(0))
    rest = lambda x, skip: F.slice(x, skip + 1, F.greatest(F.size(x) - skip, F.lit(0)))
    rolled = lambda h, c: (h * BASE + c) % PRIME

    def grams(codes, done, left):
        """done: hashes of the runs that end `gram - left - 1` words on."""
        if not left:
            whole = F.slice(done, 1, F.size(codes) - gram + 1)
            return F.transform(whole, lambda h, i: h * (1 << SHIFT) + (PRIME - i))
        return grams(codes, F.zip_with(done, rest(codes, gram - left), rolled), left - 1)

    def minima(low, wide, of):
        """low: the minimum of every `wide` values from a place on (fewer at the end, where nothing is null but what lacks)."""
        if wide == window:
            return F.array_distinct(F.slice(low, 1, F.size(of) - window + 1))
        step = min(wide, window - wide)
        return let(F.zip_with(low, rest(low, step), lambda x, y: F.least(x, y)), lambda x: minima(x, wide + step, of))

    def selected(packed):
        return F.when(F.size(packed) <= window, F.array(F.array_min(packed))).otherwise(minima(packed, 1, packed))

    def of(codes):
        short = F.array(F.aggregate(codes, F.lit(0).cast("long"), rolled) * (1 << SHIFT) + PRIME)
        none = F.array().cast("array<bigint>")
        return F.when(F.size(codes) == 0, none).when(F.size(codes) < gram, short).otherwise(let(grams(codes, codes, gram - 1), selected))

    return let(F.transform(words, hashed), of)


def hash_of(packed: Column) -> Column:
    return F.shiftright(packed, SHIFT)


def written(selected: Column) -> Column:
    """hash@position pairs, the hash in hex."""
    one = lambda x: F.concat(F.lower(F.hex(hash_of(x))), F.lit("@"), (PRIME - x.bitwiseAND(F.lit(PRIME))).cast("string"))
    return F.array_join(F.transform(selected, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the hash sets; two empty fingerprints are alike."""
    both = lambda x, y: F.size(F.array_union(x, y))
    of = lambda x, y: F.when(both(x, y) == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / both(x, y))
    hashes = lambda x: F.array_distinct(F.transform(x, hash_of))
    return let(hashes(a), lambda x: let(hashes(b), lambda y: of(x, y)))


def _below(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are <= key: binary search over a literal."""
    steps, all_bounds = [], F.array(*[F.lit(b).cast("long") for b in bounds])
    step = 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    fits = lambda at, s: (at + s <= len(bounds)) & (F.get(all_bounds, at + s - 1) <= key)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(fits(at, s), s).otherwise(F.lit(0)))


def with_next(docs: DataFrame, columns: list[str], buckets: int | None = None, derived: dict | None = None) -> DataFrame:
    """docs (doc_id, text, columns...) and next_<column> of the document that follows by id; the last is followed by the first.

    derived: further columns, taken of each row behind the shuffle.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    buckets = buckets or BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [i / buckets for i in range(buckets)]
    bounds = docs.agg(F.percentile_approx(key, parts, 20 * buckets).alias("cut"), F.min(key).alias("least")).first()
    bounds = sorted({bounds["least"], *bounds["cut"]}) if bounds["cut"] else [0]
    n = len(bounds)
    rows = docs.withColumn("__bucket", _below(bounds, key) - 1)
    opens = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("__bucket")) == key
    closing = F.struct(((F.col("__bucket") + n - 1) % n).alias("bucket"), F.lit(True).alias("closing"))
    own = F.struct(F.col("__bucket").alias("bucket"), F.lit(False).alias("closing"))
    rows = rows.withColumn("__at", F.explode(F.when(opens, F.array(own, closing)).otherwise(F.array(own))))
    rows = rows.drop("__bucket").withColumns({"__bucket": F.col("__at.bucket"), "__closing": F.col("__at.closing")}).drop("__at")
    if derived:
        rows = rows.repartition("__bucket").withColumns(derived)
    order = W.partitionBy("__bucket").orderBy("__closing", F.col("doc_id").asc_nulls_first(), "__tie")
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return rows.filter("not __closing").drop("__bucket", "__closing")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the fingerprints of its text and of its edited text, and likenesses."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("__tie"))
    rows = with_next(base, ["text", "print"], derived={"print": winnow(F.col("text"))})
    n = F.length("text")
    cut = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.left("text", n - cut), F.left("next_text", cut))
    rows = rows.select("doc_id", "print", "next_print", n.cast("long").alias("n_chars"), let(edited, lambda t: F.struct(F.sha2(t, 256).alias("sha"), winnow(t).alias("print"))).alias("edited"))
    return rows.select(
        "doc_id", "n_chars", F.col("edited.sha").alias("edited_sha256"), written(F.col("print")).alias("fingerprint"),
        written(F.col("edited.print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited.print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
