"""Writers: Spark's committer gives whole outputs or none; a rerun overwrites.  Single files are written beside their name and
renamed, so that a reader sees the old file or the new one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge import storage


def write_freq_tsv(freq: DataFrame, path: str) -> None:
    """A tab-separated table per language, in rank order within each file."""
    rows = freq.select("language", "rank", "key", "reading", "pos", "count", "doc_count")
    rows.repartition("language").sortWithinPartitions("language", "rank").write.mode("overwrite").partitionBy("language").csv(path, sep="\t", header=True, quote="", emptyValue="")


def write_entries(entries: DataFrame, path: str) -> None:
    """Entries as JSON lines, field order as in the schema, by language."""
    entries.write.mode("overwrite").partitionBy("language").json(path)


def yaml_of(entries: DataFrame) -> DataFrame:
    """(id, yaml): one document per entry, key order kept, Unicode as it is; Arrow-batched."""
    return _dumped(entries, "id")


def _dumped(entries: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` of each entry and its yaml, by libyaml where it is there."""

    def dump(batches):
        import json

        import pyarrow as pa
        import yaml

        dumper = getattr(yaml, "CSafeDumper", yaml.SafeDumper)
        for batch in batches:
            texts = (yaml.dump(json.loads(x), Dumper=dumper, allow_unicode=True, sort_keys=False) for x in batch.column("json").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "yaml"])

    body = [c for c in entries.columns if c != "path"]
    rows = entries.select(*keep, F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("json"))
    return rows.mapInArrow(dump, ", ".join(f"{c} string" for c in [*keep, "yaml"]))


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """rows (name, value) as files root/name, by the workers; returns (name, bytes) of what was written, and writes when read."""

    def write(batches):
        import pyarrow as pa

        store, path = storage.store_and_path(root)
        made = set()
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, value in zip(names, batch.column(1), strict=True):
                value = value.as_py()
                content = value.encode() if isinstance(value, str) else value
                folder = f"{path}/{name}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                storage.write_whole(store, f"{path}/{name}", content)
                sizes.append(len(content))
            yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "bytes": pa.array(sizes, pa.int64())})

    return rows.select("name", "value").mapInArrow(write, "name string, bytes long")


def write_entry_files(entries: DataFrame, root: str, kind: str) -> int:
    """One YAML file an entry, root/<kind>/<language>/<id>.yaml; returns how many."""
    name = F.concat(F.lit(f"{kind}/"), "language", F.lit("/"), "id", F.lit(".yaml"))
    return write_files(_dumped(entries, "id", "language").select(name.alias("name"), F.col("yaml").alias("value")), root).count()


def tutorial_text(tutorials: DataFrame) -> DataFrame:
    """(id, value): front matter and Markdown, without a code fence around it."""
    body = F.regexp_replace(F.regexp_replace("body", r"(?s)^\s*```(?:markdown|md)?\s*\n", ""), r"\n```\s*$", "")
    head = F.concat(F.lit("---\nid: "), "id", F.lit("\nlevel: "), "level", F.lit("\nstatus: "), "status", F.lit("\n---\n\n"))
    return tutorials.select("id", F.concat(head, body, F.lit("\n")).alias("value"))


def write_tutorials(tutorials: DataFrame, root: str) -> int:
    """One Markdown file a tutorial, root/<id>.md; returns how many."""
    return write_files(tutorial_text(tutorials).select(F.concat("id", F.lit(".md")).alias("name"), "value"), root).count()


def write_books(books: DataFrame, path: str) -> None:
    """The list of books as one YAML file in its order; a registry, some thousand rows at most."""
    import yaml

    rows = [{k: v for k, v in r.asDict().items() if k != "book_ord"} for r in books.orderBy("book_ord").collect()]
    storage.write_file(books.sparkSession, path, yaml.safe_dump(rows, allow_unicode=True, sort_keys=False))


def push_enrich(spark: SparkSession, gate: DataFrame, source: str, target: str) -> DataFrame:
    """(language, pushed, why): copies source/language=<x> to target/language=<x> where the batches are complete and the target isn't
    there yet; gate: (language, done, total, complete), a row a language."""
    made = []
    for row in gate.orderBy("language").collect():
        own, there = f"{source}/language={row.language}", f"{target}/language={row.language}"
        why = "incomplete" if not row.complete else "exists" if storage.exists(spark, there) else "no source" if not storage.exists(spark, own) else None
        if why is None:
            spark.read.text(own).write.text(there)
        made.append((row.language, why is None, why or "pushed"))
    return spark.createDataFrame(made, "language string, pushed boolean, why string")


def publish_books(books: DataFrame) -> DataFrame:
    """Books without what is internal."""
    return books.drop("sha256", "epub_path")
