import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from marketlane.llm import packing
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents


def check_layout(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms.remove(fit)
            rooms.append(fit - n)
    return len(rooms)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=150, deadline=None)
def test_moves_are_best_fit_decreasing(lengths):
    counts = Counter(lengths)
    moves = packing.best_fit_moves(counts, 40)
    placed = []
    for length in counts:
        own = moves[moves[:, 0] == length]
        for rank in range(counts[length]):
            m = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            placed.append({"sequence_id": m[2] + rank - m[1], "offset": m[3], "length": length})
    assert check_layout(placed, 40) == plain_best_fit(lengths, 40)


def test_tightest_capacity_against_search():
    tree, open_ = packing.OpenCapacities(100), Counter()
    rng = np.random.default_rng(1)
    for _ in range(500):
        c = int(rng.integers(0, 101))
        if open_[c] and rng.random() < 0.6:
            tree.add(c, -1)
            open_[c] -= 1
        else:
            tree.add(c, 1)
            open_[c] += 1
        n = int(rng.integers(0, 101))
        assert tree.tightest(n) == min((k for k, v in open_.items() if v and k >= n), default=None)


def expected_pieces(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            own = ids[start : start + packing.CAPACITY]
            yield doc_id, piece, start, len(own), zlib.crc32(own.tobytes())


def test_whole_table_equals_plain_tokenizing_and_packing(spark, small):
    docs = table(spark, small, "documents")
    rows = packing.pack_documents(docs).collect()
    want = list(expected_pieces([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    assert check_layout(rows, packing.CAPACITY) == plain_best_fit([w[3] for w in want], packing.CAPACITY)


def test_odd_rows_and_ids(spark):
    docs = documents(spark, ODD)
    rows = packing.pack_documents(docs, keep_ids=True).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(expected_pieces(ODD), key=key)
    check_layout(rows, packing.CAPACITY)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_lengths_beyond_the_capacity_are_refused(spark):
    pieces = spark.createDataFrame([(1, 0, 50)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        packing.pack(pieces, 40)
