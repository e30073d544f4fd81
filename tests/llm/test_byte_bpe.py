"""Byte-level BPE against the rank library, with an exact round trip."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pledgeflow.llm import byte_bpe, token_counts

LIBRARY = token_counts._encoding(byte_bpe.RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(text):
    coder = byte_bpe.tokenizer(byte_bpe.RANKS)
    ids = coder.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_white_space_classes():
    coder = byte_bpe.tokenizer(byte_bpe.RANKS)
    for c in "\x1c\x1d\x1e\x1f\x85\xa0 ᠎ ​　﻿":
        text = f"a{c}{c}b {c}1 {c}\n {c}"
        assert coder.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_odd_documents(odd):
    rows = byte_bpe.round_trip(odd, passed=("text",)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r.kept.text or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ids_column(odd):
    row = byte_bpe.encode_texts(odd.filter("doc_id = 4")).first()
    assert row.ids == LIBRARY.encode_ordinary(odd.filter("doc_id = 4").first().text)


def test_empty_table(no_documents):
    assert byte_bpe.round_trip(no_documents).collect() == []


def test_memo_may_overflow(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO", 2)
    text = "one two three two one " * 3 + "x" * 500
    assert byte_bpe.ByteBpe(byte_bpe.RANKS).encode(text).tolist() == LIBRARY.encode_ordinary(text)
