"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.text import let  # noqa: F401
from lexiforge.storage import work_path

# Functions of this package travel to the executors by value, so that a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules["lexiforge"])

#: The white space of the contracts, for Java's and for RE2's regular expressions.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Held while stored() writes: shuffle files go when the write is whole, and Arrow batches stay small whatever the texts are.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}
#: A side of a join is broadcast only below this many rows of two longs (about 8 MB); beyond it the join shuffles.
BROADCAST_ROWS = 400_000
#: Rows of one key that a salted join leaves together.
SPREAD = 4096


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    out = spark.read.schema(df.schema).parquet(path)
    out.lexiforge_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by stored()."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.lexiforge_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df doesn't have: what a caller's columns are called never matters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sized_broadcast(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hints a broadcast when the counted rows are few; otherwise leaves the choice to the planner."""
    return F.broadcast(df) if rows <= most else df


def salted_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row a key and in `rows` how many rows of left the key has.

    A key of over SPREAD rows is dealt over several: its row of right is copied, its rows of left are spread by their hash.
    """
    hot = stored(right.filter(F.col(rows) > SPREAD).select(*on, F.ceil(F.col(rows) / SPREAD).cast("int").alias("__parts")), "hot")
    few = hot.count()
    if not few:
        return left.join(right, on, how)
    hot = sized_broadcast(hot, few)
    left = left.withColumn("__hash", F.xxhash64(*left.columns)).join(hot, on, "left")
    left = left.withColumn("__salt", F.coalesce(F.pmod("__hash", "__parts"), F.lit(0)).cast("int")).drop("__parts", "__hash")
    right = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def trimmed(body):
    """A body of mapInArrow that gives what it freed back to the system when its partition ends: workers wait for more."""

    def run(batches):
        import contextlib
        import ctypes

        import pyarrow as pa

        try:
            yield from body(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    holder = sys.modules.setdefault("_lexiforge_worker_cache", types.ModuleType("_lexiforge_worker_cache"))
    return holder.__dict__.setdefault(name, {})


def arrow_texts(column):
    """The texts of an Arrow string column as (bytes buffer, offsets, view): null counts as empty."""
    import numpy as np
    import pyarrow as pa

    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column, kind = column.cast(pa.large_binary()), np.int64
    else:
        column, kind = column.cast(pa.binary()), np.int32
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return memoryview(b""), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return memoryview(data) if data is not None else memoryview(b""), ends


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
