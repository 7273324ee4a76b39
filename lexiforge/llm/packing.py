"""Packing token sequences by best-fit decreasing.

Documents are tokenised and end with one end token.  An overlong one is first cut into full windows, its rest is a piece.
Pieces (not texts) are dealt over partitions of some RUN pieces, however many there are; each partition sorts its own by
decreasing length and puts each into the open window with the tightest fit, found in a segment tree indexed by remaining
capacity.  Only the numbers of one run are held in memory.

Tokens are the tokenizer's, word by word: its vocabulary never spans an ASCII space, so a word's ids are looked up in a
bounded cache; words that it lacks are merged by the tokenizer's own ranks or go to the tokenizer itself (see Ids).

Defined results: null text counts as empty (one end token); repeated rows are documents like others; pieces of equal length go
in the order of (doc_id, start), null ids first, so that reruns agree; texts of any length are cut whole; an empty table gives
an empty result; a document of exactly a multiple of the window leaves no rest; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import arrow_texts, read_table, stored, trimmed, worker_cache

WINDOW, END = 2048, 1
#: Pieces that one task packs.
RUN = 250_000
#: Words that a worker's cache holds at most, and the longest word that it holds.
CACHE_WORDS, CACHE_LENGTH = 200_000, 64
#: One in so many merged words is compared with the tokenizer.
CHECKED = 256


class Capacities:
    """Segment tree over remaining capacities 0..window: which capacities have an open window."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, capacity: int, window) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int):
        """(capacity, window) of the tightest open window with at least that capacity, or None."""
        at = least + self.leaves
        if not self.count[at]:
            while at > 1 and not (at % 2 == 0 and self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths, window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """Yields (index, bin, offset) for every length (1..window), longest first, ties in the order given."""
    tree, bins = Capacities(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        capacity, where = found or (window, bins)
        bins += not found
        yield i, where, window - capacity
        if capacity > lengths[i]:
            tree.put(capacity - lengths[i], where)


def merge_ranks(path: str) -> tuple[dict[bytes, int], str]:
    """The tokenizer's vocabulary as byte ranks for a byte-pair merger, and its word pattern.

    A token that ends a word ends with byte FF, which UTF-8 never holds; the 256 pairs of a byte and FF have the lowest
    ranks after the bytes, so they merge first, as the tokenizer joins its end mark to a word's last byte.
    """
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}}
    vocabulary, mark = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(shown[c] for c in t.removesuffix(mark)) + b"\xff" * t.endswith(mark): i for t, i in vocabulary.items() if t not in special}
    ranks[b"\xff"] = max(vocabulary.values()) + 1  # never left over
    return ranks, spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]


class Ids(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes; missing ones are made, and kept while there is room.

    Printable Latin words go to a byte-pair merger with the tokenizer's own ranks, five times as fast; all others, and every
    CHECKED-th of them for comparison, go to the tokenizer itself.  Should the two ever differ, the tokenizer takes over.
    """

    def __init__(self, path: str, most: int):
        import os

        import regex
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.most, self.made, self.trusted = most, 0, True
        self.tokenizer = Tokenizer.from_file(path)
        ranks, pattern = merge_ranks(path)
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.parts = regex.compile(pattern).findall

    def exact(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        from array import array
        from itertools import chain

        if self.trusted and word.isprintable() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word)) and "<|" not in word:
            ids = list(chain.from_iterable(self.merge(p.encode() + b"\xff") for p in self.parts(word.lower())))
            self.made += 1
            if self.made % CHECKED == 1 and ids != (own := self.exact(word)):
                self.clear()
                self.trusted, self[""], ids = False, b"", own
        else:
            ids = self.exact(word)
        raw = array("I", ids)
        if sys.byteorder != "little":
            raw.byteswap()
        out = raw.tobytes()
        if len(self) < self.most and len(word) <= CACHE_LENGTH:
            self[word] = out
        return out


def encoder(path: str):
    """text -> ids as little-endian unsigned 32-bit bytes; the cache lives as long as the Python worker."""
    held = worker_cache("token ids")
    key = (path, CACHE_WORDS)
    if key not in held:
        held[key] = Ids(path, CACHE_WORDS)
    ids = held[key]

    def encode(text: str) -> bytes:
        return b"".join(map(ids.__getitem__, text.replace("\n", " ").split(" ")))

    return encode


def _cut(path: str, window: int, end: int):
    def cut(batches):
        from zlib import crc32

        import pyarrow as pa

        encode, n, last = encoder(path), 0, end.to_bytes(4, "little")
        for batch in batches:
            data, ends = arrow_texts(batch.column(1))
            out = []
            for doc, a, b in zip(batch.column(0).to_pylist(), ends[:-1], ends[1:], strict=True):
                ids = memoryview(encode(str(data[a:b], "utf-8")) + last)
                tokens = len(ids) // 4
                for start in range(0, tokens, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    n += 1
                    out.append((doc, start, len(piece) // 4, crc32(piece), tokens, n * 0x9E3779B97F4A7C15 % (1 << 63)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 6)], PIECE)

    return cut


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"]


def _pack(window: int):
    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        parts = [np.stack([np.asarray(c.fill_null(-(1 << 63))) for c in batch.columns]) for batch in batches]
        if not parts:
            return
        rows = np.concatenate(parts, 1)
        rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]  # by doc_id, start: reruns agree
        lengths = rows[2].tolist()
        placed = np.zeros((2, len(lengths)), np.int64)
        for i, where, offset in best_fit_decreasing(lengths, window):
            placed[:, i] = where, offset
        base = TaskContext.get().partitionId() << 33
        for k in range(0, len(lengths), 50_000):
            some = slice(k, k + 50_000)
            ids = pa.array(rows[0, some], mask=rows[0, some] == -(1 << 63))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x[some]) for x in rows[1:5]), pa.array(placed[0, some] + base), pa.array(placed[1, some])], [*PIECE[:5], "sequence_id", "offset"])

    return pack


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(slim.mapInArrow(trimmed(_cut(tokenizer, window, end)), ", ".join(f"{c} long" for c in PIECE)), "pieces")
    kinds = ", ".join(f"{c} long" for c in [*PIECE[:5], "sequence_id", "offset"])
    runs = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pieces.count() // RUN))
    return pieces.repartition(runs, "deal").mapInArrow(_pack(window), kinds)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path())
