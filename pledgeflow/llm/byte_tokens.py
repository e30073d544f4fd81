"""Token ids of whole texts by a byte-level tokenizer file, through the distinct pre-tokens of a batch.

The pre-token pattern looks at four classes of characters only, so the places where pre-tokens
begin follow from comparisons of whole arrays. Distinct pre-tokens are encoded by the tokenizers
library once and kept in a worker's memo.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

# pre-tokens kept in a worker's memo, the longest that is kept, and text bytes encoded at once (of one text at least)
MEMO, MEMO_CHARS, CHUNK_BYTES = 400_000, 48, 4 << 20
_OTHER, _SPACE, _LETTER, _NUMBER = range(4)
# endings that are split off behind an apostrophe
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point by the library's own regular expressions: white space, letter, number or other."""
    points = np.delete(np.arange(sys.maxunicode + 1, dtype=np.uint32), np.s_[0xD800:0xE000])
    text = points.tobytes().decode("utf-32-le")
    classes = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for kind, name in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        held = np.ones(len(points), bool)
        for _, (first, last) in Split(Regex(name), "removed").pre_tokenize_str(text):
            held[first:last] = False
        classes[points[held]] = kind
    return classes


def pre_token_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point; ``first`` marks the beginnings of texts.

    A run of one class is a pre-token and takes a blank before it along. Of longer white space
    the last character stands alone, unless the text ends with it. An apostrophe that begins a
    pre-token is joined by one of the fixed endings.
    """
    n = len(points)
    kind = character_classes()[points]
    space = kind == _SPACE
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    starts = run.copy()
    ends_space = np.zeros(n, bool)  # a white-space character before another class of the same text
    ends_space[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    starts |= ends_space
    starts[1:] &= ~(ends_space & (points == 0x20))[:-1]
    marks = np.flatnonzero((points == 0x27) & starts)
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    new_text = np.concatenate([first, np.ones(3, bool)])
    for ending in _ENDINGS:
        held = marks
        for i, c in enumerate(ending, 1):
            held = held[(padded[held + i] == ord(c)) & ~new_text[held + i]]
        starts[held + 1] = False
        after = held + 1 + len(ending)
        after = after[after < n]
        starts[after[kind[after] == _LETTER]] = True
    return starts


class ByteTokenizer:
    """Ids of texts as the tokenizers library gives them, without special tokens."""

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        self.model = self.full.model
        shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
        hidden = [b for b in range(256) if b not in shown]
        characters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.characters = [characters[b] for b in range(256)]
        self.size = self.full.get_vocab_size()
        self.memo: dict[str, bytes] = {}

    def _ids(self, pre_token: str) -> bytes:
        ids = self.memo.get(pre_token)
        if ids is None:
            text = "".join([self.characters[b] for b in pre_token.encode()])
            ids = array("I", [token.id for token in self.model.tokenize(text)]).tobytes()
            if len(pre_token) <= MEMO_CHARS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[pre_token] = ids
        return ids

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a string array without nulls."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = b"" if data is None else data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()
        if not raw:
            yield from (np.zeros(0, np.uint32) for _ in range(len(texts)))
            return
        bounds = offsets - offsets[0]
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        byte = np.frombuffer(raw, np.uint8)
        at = np.flatnonzero((byte & 0xC0) != 0x80)  # first byte of each code point
        first = np.zeros(len(raw), bool)
        first[bounds[:-1][bounds[:-1] < len(raw)]] = True
        tokens = at[pre_token_starts(points, first[at])]
        ends = np.append(tokens, len(raw)).astype(np.int32 if len(raw) < 1 << 31 else np.int64)
        make = pa.StringArray if ends.dtype == np.int32 else pa.LargeStringArray
        coded = make.from_buffers(len(tokens), pa.py_buffer(ends), pa.py_buffer(raw)).dictionary_encode()
        packed = [self._ids(p) for p in coded.dictionary.to_pylist()]
        sizes = np.array([len(ids) // 4 for ids in packed], np.int64)
        begins = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(packed), np.uint32)
        index = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[index]
        last = np.cumsum(lengths)
        flat = ids[np.repeat(begins[index] - (last - lengths), lengths) + np.arange(int(last[-1]))]
        cuts = np.concatenate([[0], last])[np.searchsorted(tokens, bounds)]
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield flat[low:high]


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def by_bytes(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of about ``CHUNK_BYTES`` of text, of one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last
