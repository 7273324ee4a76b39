"""WARC archives and an external index merge.

Writing: each task streams its rows into files of at most FILE_RECORDS records in the shared folder, each record a gzip
member; a file is moved to its final name only when whole, so that a task that runs again leaves no half file.  Of records
with equal payloads the one with the largest page_id is a response, others revisit it; small payloads are always responses.

Reading: tasks stream the files record by record; the captures of a file, at most FILE_RECORDS, are sorted and written as a run
into the shared folder, in blocks of BLOCK_ROWS whose first keys are returned.

Index merge: an external k-way merge.  While there are more than FAN_IN runs, groups of FAN_IN become one longer run each.  The
last round is cut by splitters over (url key, timestamp, page_id, file, offset), taken from a bounded sample of the blocks'
first keys, so that even one url key with a third of all captures spreads over many tasks; a task opens its part of every run
and plays a loser tree over them with one block of each in memory.  The result is in global order, partition by partition.

Recovery: a run's name holds the attempt that wrote it, and only the names of attempts that count are returned; an archive is
renamed when whole, over one that an earlier attempt of the same task may have left.

Defined results: null html is an empty payload; a null url is written as an empty target; a null page_id sorts after all
others and is never the response of a group that has another; payloads of any length are written whole; ties of url key and
timestamp go by page_id, then by place in the archives; repeated rows are captures each; an empty table gives an empty result;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.llm._shared import read_table, sized_broadcast, stored
from lexiforge.storage import work_path

LEAST_BYTES, FILE_RECORDS = 1000, 20_000
#: Runs that one merge opens, rows of a block, rows that a part of the last merge should have, and its parts at most.
FAN_IN, BLOCK_ROWS, PART_ROWS, PARTS = 1024, 250, 20_000, 10_000
#: Sampled first keys for every part.
KEYS_OF_PART = 20
EPOCH = 1_577_836_800  # 2020-01-01: a page's capture time is this plus page_id seconds, for tables without one


def url_key(url: str) -> str:
    """The host's labels reversed, then path and query: captures of one site sort together."""
    found = re.match(r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url or "")
    if not found:
        return f"){url or ''}"
    host = found[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (found[2] or "/")


def record(page_id, url: str, stamp: str, digest: str, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the response's headers and no payload."""
    import base64

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda n: f"<urn:page:{'null' if n is None else n}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {stamp}"]
    head += [f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", url or "")


def _write(folder: str):
    def write(batches):
        import time
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        task = TaskContext.get()
        out, count, name, done = None, 0, "", []

        def close():
            out.close()
            try:
                store.move(f"{name}.{task.taskAttemptId()}", name)
            except OSError:  # some stores don't rename over what an earlier attempt left
                store.delete_file(name)
                store.move(f"{name}.{task.taskAttemptId()}", name)
            done.append((name, count))

        for batch in batches:
            for page, url, html, digest, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or count == FILE_RECORDS:
                    if out:
                        close()
                    name, count = f"{root}/{task.partitionId():08d}-{len(done):05d}.warc.gz", 0
                    out = store.open_output_stream(f"{name}.{task.taskAttemptId()}", compression=None)
                stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(EPOCH + (page or 0) % 1_000_000_000))
                made = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(made.compress(record(page, _one_line(url), stamp, digest, (html or "").encode(), other)) + made.flush())
                count += 1
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[], []], (pa.string(), pa.int64()), strict=True)], ["file", "records"])

    return write


def read_records(stream) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, headers, block) of each record of a stream of gzip members; holds one record at a time."""
    import zlib

    offset, rest = 0, b""
    while rest or (rest := stream.read(1 << 20)):
        member, parts, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            if not rest and not (rest := stream.read(1 << 20)):
                raise ValueError(f"the archive ends inside the record at {offset}")
            parts.append(member.decompress(rest))
            used += len(rest) - len(member.unused_data)
            rest = member.unused_data
        head, _, block = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        if lines[0] != "WARC/1.1" or block[size:] != b"\r\n\r\n":
            raise ValueError(f"no record at {offset}")
        yield offset, used, headers, block[:size]
        offset += used


CAPTURE = "url_key string, stamp string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
#: A block of a run: where it is, how many rows it has, and the sort key of its first row.
BLOCK = "run string, block int, rows int, url_key string, stamp string, no_id boolean, page_id long, file string, offset long"
KEY = ["url_key", "stamp", "no_id", "page_id", "file", "offset"]


def _schema(ddl: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])


def _batch(rows: list[tuple], ddl: str):
    import pyarrow as pa

    schema = _schema(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is None, row[2] or 0, row[8], row[9]


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else fs.LocalFileSystem()


def _path(uri: str) -> str:
    """The path that the store of a uri takes."""
    scheme, host, path = re.match(r"^(?:([a-z0-9]+):(?://([^/]*))?)?(.*)$", uri).groups()
    return path if scheme in (None, "file", "hdfs", "viewfs") else f"{host}{path}"


def _write_run(store, path: str, rows: Iterator[tuple]) -> list[tuple]:
    """Writes sorted captures block by block; returns BLOCK rows."""
    from itertools import islice

    import pyarrow as pa

    blocks = []
    with store.open_output_stream(path, compression=None) as out, pa.ipc.new_file(out, _schema(CAPTURE), options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        while block := list(islice(rows, BLOCK_ROWS)):
            writer.write_batch(_batch(block, CAPTURE))
            blocks.append((path, len(blocks), len(block), *_order(block[0])))
    return blocks


def _read_run(store, path: str, first: int, last: int) -> Iterator[tuple]:
    """The captures of the blocks first..last of a run; one block is held."""
    import pyarrow as pa

    with store.open_input_file(path) as file:
        reader = pa.ipc.open_file(file)
        for k in range(first, last + 1):
            yield from zip(*(c.to_pylist() for c in reader.get_batch(k).columns), strict=True)


def _captures(folder: str, root: str):
    """Archive files to sorted runs in the folder `root`; yields BLOCK rows."""

    def read(batches):
        import base64
        import hashlib

        from pyspark import TaskContext

        store, task, n = _store(folder), TaskContext.get(), 0
        number = lambda x: None if x == "<urn:page:null>" else int(x[10:-1])
        for batch in batches:
            for file in batch.column(0).to_pylist():
                run = []
                with store.open_input_stream(file, compression=None) as stream:
                    for offset, length, head, block in read_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
                        if head["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"the payload at {offset} of {file} isn't what was written")
                        other = head.get("WARC-Refers-To")
                        url = head["WARC-Target-URI"]
                        run.append((url_key(url), head["WARC-Date"], number(head["WARC-Record-ID"]), url, size, digest, head["WARC-Type"], other and number(other), file, offset, length))
                run.sort(key=_order)
                n += 1
                yield _batch(_write_run(store, f"{root}/run-0-{task.partitionId()}-{task.taskAttemptId()}-{n}", iter(run)), BLOCK)

    return read


def loser_tree(runs: list[Iterator], key) -> Iterator:
    """Merges sorted runs: inner nodes hold the losers, and a new head plays only on its way to the root.

    Of a run only its next row is held here.
    """
    runs = [iter(r) for r in runs]
    k = len(runs)
    if k < 2:
        yield from (runs[0] if k else ())
        return
    end = (1,)
    rows = [None] * k
    head: list[tuple] = [end] * k
    losers = [-1] * k

    def advance(run: int) -> None:
        try:
            rows[run] = next(runs[run])
            head[run] = (0, key(rows[run]))
        except StopIteration:
            rows[run], head[run] = None, end

    def play(run: int) -> int:
        node = (run + k) // 2
        while node:
            other = losers[node]
            if other < 0:  # the first of two to come waits here
                losers[node] = run
                return -1
            if (head[other], other) < (head[run], run):
                losers[node], run = run, other
            node //= 2
        return run

    winner = -1
    for run in range(k):
        advance(run)
        winner = max(winner, play(run))
    while head[winner] != end:
        yield rows[winner]
        advance(winner)
        winner = play(winner)


def _merged(store, parts: list[tuple], low, high) -> Iterator[tuple]:
    """The captures of the run parts (run, first block, last block) with low <= key < high, in order."""
    inside = lambda run: (r for r in run if (low is None or _order(r) >= low) and (high is None or _order(r) < high))
    return loser_tree([inside(_read_run(store, *p)) for p in parts], _order)


def _join_runs(folder: str, root: str, turn: int):
    """Rows (node, run, blocks) sorted by node: each node's runs become one; yields BLOCK rows."""

    def join(batches):
        from itertools import groupby

        from pyspark import TaskContext

        store, task = _store(folder), TaskContext.get()
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for node, own in groupby(rows, key=lambda r: r[0]):
            merged = _merged(store, [(run, 0, blocks - 1) for _, run, blocks in own], None, None)
            yield _batch(_write_run(store, f"{root}/run-{turn}-{node}-{task.taskAttemptId()}", merged), BLOCK)

    return join


def _dealt(splitters: list[tuple]):
    """BLOCK rows with `next` (the first key of the run's next block, or null) to (part, run, block)."""

    def dealt(batches):
        from bisect import bisect_left, bisect_right

        import pyarrow as pa

        for batch in batches:
            cols = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)}
            out = []
            for k in range(batch.num_rows):
                low = bisect_right(splitters, tuple(cols[c][k] for c in KEY))
                after = cols["next"][k]
                high = len(splitters) if after is None else bisect_left(splitters, tuple(after[c] for c in KEY))
                out += [(part, cols["run"][k], cols["block"][k]) for part in range(low, high + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.int32(), pa.string(), pa.int32()), strict=True)], ["part", "run", "block"])

    return dealt


def _merge(folder: str, splitters: list[tuple]):
    """Rows (part, run, first, last) sorted by part to the captures of the parts, in order."""

    def merge(batches):
        from itertools import groupby, islice

        store = _store(folder)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part, own in groupby(rows, key=lambda r: r[0]):
            low, high = splitters[part - 1] if part else None, splitters[part] if part < len(splitters) else None
            merged = _merged(store, [r[1:] for r in own], low, high)
            while block := list(islice(merged, 5000)):
                yield _batch(block, CAPTURE)

    return merge


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives into folder; returns the table of files (file, records)."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    large = rows.filter(F.octet_length("html") >= LEAST_BYTES)
    last = stored(large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("d"), "last"), "payloads")
    rows = rows.join(sized_broadcast(last, last.count(), 100_000), F.col("digest") == F.col("d"), "left")
    # a second row with the response's own page_id is a response too; a null id always gives way
    other = F.when(F.col("page_id") == F.col("last"), None).otherwise(F.col("last"))
    return stored(rows.select("page_id", "url", "html", "digest", other.alias("other")).mapInArrow(_write(folder), "file string, records long"), "archives")


def merged_index(files: DataFrame, folder: str) -> DataFrame:
    """The captures of the archives in global order of (url_key, stamp, page_id); files: (file, records)."""
    spark = files.sparkSession
    root = work_path(spark, "runs")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    root = _path(root)
    size = files.agg(F.count("*").alias("n"), F.sum("records").alias("records")).first()
    if not size["n"]:
        return spark.createDataFrame([], CAPTURE)
    # a task for each file, as long as those are few; a number that is asked for is not coalesced
    blocks = stored(files.select("file").repartition(min(size["n"], PARTS)).mapInArrow(_captures(folder, root), BLOCK), "blocks")
    runs, turn = size["n"], 0
    while runs > FAN_IN:
        turn += 1
        own = blocks.groupBy("run").agg(F.count("*").cast("int").alias("blocks"), F.min("url_key").alias("k"))
        nodes = -(-runs // FAN_IN)
        own = own.select(F.pmod(F.xxhash64("run"), F.lit(nodes)).cast("int").alias("node"), "run", "blocks")
        joined = own.repartition(min(nodes, PARTS), "node").sortWithinPartitions("node", "run").mapInArrow(_join_runs(folder, root, turn), BLOCK)
        blocks, runs = stored(joined, f"blocks-{turn}"), nodes
    parts = min(PARTS, max(1, -(-size["records"] // PART_ROWS)))
    share = max(1, size["records"] // BLOCK_ROWS // (KEYS_OF_PART * parts))
    keys = blocks.filter(F.pmod(F.xxhash64("run", "block"), F.lit(share)) == 0).select(KEY).sort(KEY).limit(4 * KEYS_OF_PART * parts + 1000).collect()
    keys = [tuple(r) for r in keys]
    splitters = sorted({keys[k * len(keys) // parts] for k in range(1, parts)}) if keys else []
    after = F.lead(F.struct(*KEY)).over(W.partitionBy("run").orderBy("block"))
    dealt = blocks.withColumn("next", after).select(*KEY, "run", "block", "next").mapInArrow(_dealt(splitters), "part int, run string, block int")
    dealt = stored(dealt.groupBy("part", "run").agg(F.min("block").alias("first"), F.max("block").alias("last")), "parts")
    return dealt.repartitionByRange(parts, "part").sortWithinPartitions("part", "run").mapInArrow(_merge(folder, splitters), CAPTURE)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes and reads back: one row per page with its place in the archives."""
    spark = pages.sparkSession
    folder = work_path(spark, "warc")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return merged_index(write_archives(pages, folder, id_col, url_col, html_col), folder)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) ELSE page_id END AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM g"""
