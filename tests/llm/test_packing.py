"""Packing against the tokenizer itself and against bounds on bins."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgeflow.llm import packing


def brute_ids(text):
    tokenizer = packing.word_tokenizer(packing.TOKENIZER).full
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def check_placement(rows, size):
    """Every sequence is filled gaplessly from 0 to at most its size."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return len(sequences)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBéÈßİΣ'sλ1²½.,!-—中🙂́   \n\t\x1c\x00<|>"), max_size=40), min_size=1))
def test_word_tokenizer_equals_the_library(texts):
    got = packing.word_tokenizer(packing.TOKENIZER).encode(pa.array(texts, pa.string()))
    assert [ids.tolist() for ids in got] == [brute_ids(t) for t in texts]


def test_memo_may_overflow(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    texts = ["the cat sat, on; the mat!", "x" * 200 + " y"] * 3
    got = packing.WordTokenizer(packing.TOKENIZER).encode(pa.array(texts))
    assert [ids.tolist() for ids in got] == [brute_ids(t) for t in texts]


def test_odd_documents(odd):
    rows = packing.pack_documents(odd, passed=("doc_id", "text"), size=256).collect()
    check_placement(rows, 256)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.kept.doc_id, r.kept.text].append(r)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    for (_, text), found in pieces.items():
        ids = np.array([*brute_ids(text), 0], "<u4")
        for r in found:
            assert r.start == 256 * r.piece
            assert r.length == len(ids[r.start : r.start + 256])
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + 256].tobytes())


def test_ids_are_kept_on_request(odd):
    row = packing.token_pieces(odd.filter("doc_id = 4"), with_ids=True).first()
    assert row.ids == [*brute_ids(odd.filter("doc_id = 4").first().text), 0]


def test_empty_table(no_documents):
    assert packing.pack_documents(no_documents).collect() == []


def test_levels_place_every_row_once(spark):
    rng = random.Random(4)
    lengths = [rng.randint(1, 100) for _ in range(3000)] + [100, 100, 7, 7, 7]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "i long, length long")
    rows = packing.pack(pieces, 100, group_rows=400).collect()
    assert sorted(r.i for r in rows) == list(range(len(lengths)))
    assert check_placement(rows, 100) <= math.ceil(sum(lengths) / 100) * 1.03
    assert len(packing.pack_lengths(lengths, 100)) <= math.ceil(sum(lengths) / 100) * 1.01


def test_local_search_raises_squared_fill_and_empties_bins():
    lengths = [6, 3, 5, 5, 4, 4, 3]
    start = [[0, 1], [2, 4], [3, 5], [6]]  # fills 9, 9, 9, 3 of 10
    found = packing.local_search([list(b) for b in start], lengths, 10)
    assert sorted(i for b in found for i in b) == list(range(7))
    fills = sorted(sum(lengths[i] for i in b) for b in found)
    assert len(found) == 3 and fills == [10, 10, 10]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_bins_hold_and_improve(lengths):
    start = packing.best_fit(lengths, 64)
    found = packing.local_search([list(b) for b in start], lengths, 64)
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 64 for b in found)
    square = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert square(found) >= square(start) and len(found) <= len(start)
