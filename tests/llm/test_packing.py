import random
import zlib
from collections import defaultdict

import numpy as np

from lexiforge.llm import packing as M
from tests.llm.fixtures import documents, odd_rows


def slow_best_fit(lengths, window):
    bins, total = [], 0
    for n in sorted(lengths, reverse=True):
        fits = [k for k, used in enumerate(bins) if used + n <= window]
        if fits:
            bins[max(fits, key=lambda k: bins[k])] += n
        else:
            bins.append(n)
        total += n
    return sorted(bins)


def test_segment_tree_is_best_fit_decreasing():
    rng = random.Random(2)
    for window in (7, 64, 100):
        lengths = [rng.randint(1, window) for _ in range(300)]
        bins, ends = defaultdict(int), set()
        for i, where, offset in M.best_fit_decreasing(lengths, window):
            assert bins[where] == offset
            bins[where] += lengths[i]
            ends.add(i)
        assert len(ends) == len(lengths) and sorted(bins.values()) == slow_best_fit(lengths, window)
    assert list(M.best_fit_decreasing([], 8)) == []


def check_round_trip(rows, pieces, window=M.WINDOW):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(M.tokenizer_path())
    texts = defaultdict(list)
    for d, t, *_ in rows:
        texts[d].append(np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    want = sorted(((d is None, d or 0), s, len(x[s : s + window]), zlib.crc32(x[s : s + window].tobytes()), len(x)) for d, own in texts.items() for x in own for s in range(0, len(x), window))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


def test_pieces_equal_the_tokenizer(spark):
    rows = [*odd_rows(), (1000, "It's DON'T <|endoftext|> ﬁ Ⅷ é é\r\nx\x1cy\x85z　w İ Σς 123,4", "en", "a", 1), (1001, "東京" * 400, "en", "a", 1)]
    assert check_round_trip(rows, M.pack(documents(spark, rows).repartition(3), M.tokenizer_path()).collect())


def test_little_padding(spark, sf_dir):
    from lexiforge.llm._shared import read_table

    docs = read_table(spark, sf_dir, "documents")
    pieces = M.op1_packing(spark, sf_dir).collect()
    n = check_round_trip([(r.doc_id, r.text) for r in docs.collect()], pieces)
    total = sum(r.length for r in pieces)
    assert n * M.WINDOW - total <= 0.03 * total


def test_cache_that_overflows(monkeypatch):
    monkeypatch.setattr(M, "CACHE_WORDS", 5)
    encode = M.encoder(M.tokenizer_path())
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(M.tokenizer_path())
    for t in ("a b c d e f g h", "", "x" * 100 + " a", "a\nb\n\nc", "q r s t u v a b"):
        assert encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_tokenizer_takes_over_from_a_wrong_merger():
    from tokenizers import Tokenizer

    ids = M.Ids(M.tokenizer_path(), 100)
    ids.merge = lambda piece: [9]
    tok = Tokenizer.from_file(M.tokenizer_path())
    for word in ("some", "words", "some"):
        assert ids[word] == np.array(tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
    assert not ids.trusted


def test_many_runs(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN", 9)
    rows = odd_rows()
    made = M.pack(documents(spark, rows), M.tokenizer_path())
    pieces = made.collect()
    assert made.rdd.getNumPartitions() == -(-len(pieces) // 9) > 4
    assert check_round_trip(rows, pieces) > 4


def test_empty_table(spark):
    assert M.pack(documents(spark, []), M.tokenizer_path()).count() == 0
