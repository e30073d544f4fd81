"""Byte-level BPE through a sentencepiece model written straight from the rank file.

Each vocabulary entry becomes a piece: its bytes mapped to printable characters, scored by
its negative rank, so that sentencepiece's best-score merges are the lowest-rank merges.
Normalisation is the identity. A text is split by the pre-token pattern, every pre-token is
mapped and encoded; decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterable, Sequence
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import map_texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# pre-tokens kept in a worker's memo, and the longest that is kept
MEMO, MEMO_CHARS = 300_000, 64


def byte_characters() -> list[str]:
    """A printable character for each byte; printable Latin-1 stands for itself."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: bytes, integer or float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def sentencepiece_model(tokens: Sequence[bytes]) -> bytes:
    """Serialised model: piece i is token i with score -i; the last piece is the unknown one."""
    mapped = byte_characters()
    pieces = [("".join(mapped[b] for b in token), -float(rank), 1) for rank, token in enumerate(tokens)]
    pieces.append(("<unk>", 0.0, 2))
    body = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, kind)) for p, s, kind in pieces)
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens))
    trainer += b"".join(_field(number, -1) for number in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(number, 0) for number in (3, 4, 5))
    return body + _field(2, trainer) + _field(3, normalizer)


class ByteBpe(dict):
    """Encoder and decoder of one rank file; as a dict, the memo of pre-token -> packed ids."""

    def __init__(self, path: str):
        super().__init__()
        tokens = read_ranks(path)
        self.mapped = byte_characters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        back = {c: b for b, c in enumerate(self.mapped)}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.split = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def __missing__(self, pre_token: str) -> bytes:
        raw = pre_token.encode()
        text = pre_token if raw.isalnum() else "".join([self.mapped[b] for b in raw])
        ids = array("I", self.model.encode(text)).tobytes()
        if len(pre_token) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[pre_token] = ids
        return ids

    def encode(self, text: str) -> array:
        """Token ids of a whole text."""
        return array("I", b"".join(map(self.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_texts(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",), ranks: str = RANKS) -> DataFrame:
    """``kept`` (struct of passed columns) and ``ids`` of each whole text; a null text is empty.

    ``ranks`` is a rank file that every executor can open. Very long texts are encoded whole.
    """

    def encode(raw: bytes) -> list[tuple[array]]:
        return [(tokenizer(ranks).encode(raw.decode()),)]

    return map_texts(df, text, passed, [("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], encode)


def round_trip(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",), ranks: str = RANKS) -> DataFrame:
    """Encode every text, decode the ids, and return digests of both without moving the ids.

    ``kept``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256`` (decoded bytes). A null or empty text has no ids; repeated rows are
    treated alike; an empty table gives no rows.
    """

    def digest(raw: bytes) -> list[tuple[int, str, str]]:
        coder = tokenizer(ranks)
        ids = coder.encode(raw.decode())
        shown = " ".join(map(str, ids)).encode()
        return [(len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest())]

    fields = [
        ("n_tokens", T.LongType(), pa.int64()),
        ("ids_sha256", T.StringType(), pa.string()),
        ("decoded_sha256", T.StringType(), pa.string()),
    ]
    return map_texts(df, text, passed, fields, digest)
