"""Token files against the tokenizers library, and access to single tokens."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pledgeflow.llm import byte_tokens, direct_codes, queries
from pledgeflow.session import work_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    full = Tokenizer.from_file(direct_codes.TOKENIZER)
    full.encode_special_tokens = True
    return full


def brute(documents, library):
    """(key, start, n, crc) of (key, text) rows in ascending order of the key, nulls first."""
    out, start = [], 0
    for key, text in sorted(documents, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_direct_codes"](spark, SF).collect()
    assert sorted(map(tuple, got)) == brute(map(tuple, docs), library)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBéÈßİ'strvemdlΣ1²½.,!-—中🙂́   \n\t\x1c\x85<|>"), max_size=40), min_size=1))
def test_tokenizer_equals_the_library(texts):
    coder = byte_tokens.byte_tokenizer(direct_codes.TOKENIZER)
    want = [coder.full.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in coder.encode(pa.array(texts, pa.string()))] == want
    assert [ids.tolist() for ids in coder.encode(pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts)))] == want


def test_every_code_point_begins_pre_tokens_as_in_the_library(library):
    coder = byte_tokens.byte_tokenizer(direct_codes.TOKENIZER)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}'s\n" for c in points[i : i + 2000]) for i in range(0, len(points), 2000)]
    got = coder.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_memo_may_overflow(monkeypatch, library):
    monkeypatch.setattr(byte_tokens, "MEMO", 3)
    texts = ["the cat sat, on; the mat!", "x" * 200 + " y"] * 3
    got = byte_tokens.ByteTokenizer(direct_codes.TOKENIZER).encode(pa.array(texts))
    assert [ids.tolist() for ids in got] == [library.encode(t).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_any_token_of_a_segment(ids, data):
    cut = data.draw(st.integers(0, len(ids)))
    raw = direct_codes.Segment.pack(np.array(ids, np.uint32), [-5, None], [0, cut, len(ids)], 7, 9)
    segment = direct_codes.Segment(raw + b"\n")
    assert (segment.task, segment.number, segment.n_tokens) == (7, 9, len(ids))
    assert [segment.document(i).tolist() for i in (0, 1)] == [ids[:cut], ids[cut:]]
    assert segment.keys[0] == -5 and segment.has_key.tolist() == [1, 0]
    if ids:
        wanted = data.draw(st.lists(st.integers(0, len(ids) - 1)))
        assert segment.tokens(np.array(wanted, np.int64)).tolist() == [ids[i] for i in wanted]


def test_other_bytes_are_no_segment():
    with pytest.raises(ValueError):
        direct_codes.Segment(bytes(64))


def test_odd_documents_and_small_segments(spark, odd, no_documents, library):
    documents = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute(documents, library)
    for tokens in (100, 1 << 20):
        path = work_path(spark, "tokens")
        direct_codes.write_tokens(odd, path, segment_tokens=tokens)
        got = sorted(map(tuple, direct_codes.read_documents(spark, path).collect()), key=lambda r: r[1])
        # rows that share a key are in any order
        assert [r[0] for r in got] == [r[0] for r in want]
        assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in want)
        assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    path = work_path(spark, "tokens")
    direct_codes.write_tokens(no_documents, path)
    assert direct_codes.read_documents(spark, path).collect() == []


def test_random_tokens_from_written_files(spark, library):
    rng = random.Random(2)
    texts = {i: "".join(rng.choice("ab c,é\n中") for _ in range(rng.randint(0, 90))) for i in range(60)}
    path = work_path(spark, "tokens")
    direct_codes.write_tokens(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path, segment_tokens=200)
    for row in spark.read.format("binaryFile").load(path).filter("length > 0").collect():
        segment = direct_codes.Segment(row.content)
        for key, start, end in zip(segment.keys.tolist(), segment.starts.tolist(), segment.starts.tolist()[1:]):
            ids = [*library.encode(texts[key]).ids, 0]
            i = rng.randrange(len(ids))
            assert end - start == len(ids) and segment.tokens(np.array([start + i])).tolist() == [ids[i]]
