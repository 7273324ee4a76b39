"""Where tables and files between steps go: a folder that the driver and all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where it is unset (tests) a folder in the warehouse."""
    known = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lexiforge-checkpoints")
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def work_path(spark: SparkSession, name: str, make: bool = False) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/lexiforge-{name}-{uuid.uuid4().hex}"
    store, where = _hadoop(spark, path)
    store.deleteOnExit(where)
    if make:
        store.mkdirs(where)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its plan is cut, and it is there when executors are lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _hadoop(spark, path)
    return store.exists(where)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written beside its name, then renamed over it."""
    store, where = _hadoop(spark, path)
    _, beside = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if store.exists(where):
        store.delete(where, False)
    if not store.rename(beside, where):
        raise OSError(f"{path} could not be written")


def store_and_path(uri: str):
    """The file system of a uri for a worker, and the path that it takes."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def local_path(uri: str) -> str | None:
    """The path of a folder that driver and workers mount, or null for other stores."""
    if uri.startswith("file:"):
        return re.sub("^file:/+", "/", uri)
    return uri if uri.startswith("/") else None


def write_whole(store, path: str, content: bytes) -> None:
    """A file of a worker, whole or not at all; an earlier attempt's file is replaced."""
    beside = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(beside, compression=None) as out:
        out.write(content)
    try:
        store.move(beside, path)
    except OSError:  # some stores don't rename over a file
        store.delete_file(path)
        store.move(beside, path)
