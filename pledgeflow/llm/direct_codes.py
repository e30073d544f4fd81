"""Token ids in binary files of directly addressable codes.

An id is split into bytes, the lowest first. Level one holds the first byte of every id, the next
level the second byte of those that have one, and so on. A bitmap beside each level tells which
ids go on, and a directory of ranks beside it where: the k-th id that goes on is the k-th of the
next level. So any token is read by one look-up per level, without decoding what lies before it.

A file is one segment: header, documents in ascending order of their key with the place where each
begins, then the levels. Spark writes and reads the files, so they may lie in any store it knows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pledgeflow.llm.byte_tokens import by_bytes, byte_tokenizer
from pledgeflow.llm.text_batches import ship
from pledgeflow.session import broadcast_if_small, materialise

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MAGIC = b"DACS"
# magic, levels, task that wrote the segment, its number there, tokens, documents
_HEADER = struct.Struct("<4sIQQQQ")
# tokens of a segment (a longer document has one of its own), text bytes of a task that writes them, and such tasks at most
SEGMENT_TOKENS, TASK_BYTES, MOST_TASKS = 1 << 23, 1 << 25, 20_000
_BLOCK = 512


def _padded(raw: bytes, to: int = 8) -> bytes:
    return raw + bytes(-len(raw) % to)


class Level:
    """Bytes of one level; unless it is the last, which of them go on and their ranks."""

    def __init__(self, chunks: np.ndarray, bits: np.ndarray | None, blocks: np.ndarray | None, words: np.ndarray | None):
        self.chunks, self.bits, self.blocks, self.words = chunks, bits, blocks, words

    @classmethod
    def of(cls, values: np.ndarray) -> tuple[Level, np.ndarray]:
        """The level of ``values`` and what is left for the next one."""
        more = values > 0xFF
        packed = np.packbits(more, bitorder="little").tobytes()
        bits = np.frombuffer(_padded(packed, _BLOCK // 8), "<u8")
        counts = np.bitwise_count(bits).astype(np.int64).reshape(-1, _BLOCK // 64)
        words = (np.cumsum(counts, axis=1) - counts).astype("<u2")
        totals = counts.sum(axis=1)
        blocks = (np.cumsum(totals) - totals).astype("<u4")
        return cls((values & 0xFF).astype(np.uint8), bits, blocks, words.ravel()), values[more] >> 8

    def goes_on(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ids before ``at`` go on."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        inside = np.bitwise_count(self.bits[at >> 6] & below)
        return self.blocks[at // _BLOCK].astype(np.int64) + self.words[at >> 6] + inside


class Segment:
    """A segment in memory: documents' keys and beginnings, and tokens by position."""

    def __init__(self, raw: bytes | memoryview):
        raw = memoryview(raw)
        magic, levels, self.task, self.number, self.n_tokens, n_docs = _HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        place = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            found = np.frombuffer(raw, kind, n, place)
            place += -(-found.nbytes // 8) * 8
            return found

        sizes = take("<u8", levels).tolist()
        self.keys, self.has_key, self.starts = take("<i8", n_docs), take("u1", n_docs), take("<i8", n_docs + 1)
        self.levels = []
        for i, n in enumerate(sizes):
            chunks, blocks = take("u1", n), -(-n // _BLOCK)
            rest = [None] * 3 if i == levels - 1 else [take("<u8", blocks * _BLOCK // 64), take("<u4", blocks), take("<u2", blocks * _BLOCK // 64)]
            self.levels.append(Level(chunks, *rest))

    @staticmethod
    def pack(ids: np.ndarray, keys: Sequence[int | None], starts: Sequence[int], task: int = 0, number: int = 0) -> bytes:
        """Serialise ids of whole documents; ``starts`` has one more entry than ``keys``."""
        levels, rest = [], np.ascontiguousarray(ids, np.uint32)
        while True:
            level, rest = Level.of(rest)
            levels.append(level)
            if not len(rest):
                break
        parts = [np.array([len(x.chunks) for x in levels], "<u8")]
        parts += [np.array([k or 0 for k in keys], "<i8"), np.array([k is not None for k in keys], "u1"), np.array(starts, "<i8")]
        for level in levels:
            parts.append(level.chunks)
            if level is not levels[-1]:
                parts += [level.bits, level.blocks, level.words]
        head = _HEADER.pack(MAGIC, len(levels), task, number, len(ids), len(keys))
        return head + b"".join(_padded(x.tobytes()) for x in parts)

    def tokens(self, positions: np.ndarray) -> np.ndarray:
        """Ids at any positions of the segment, each found by itself."""
        at = np.asarray(positions, np.int64)
        out, held = np.zeros(len(at), np.uint32), np.arange(len(at))
        for shift, level in enumerate(self.levels):
            out[held] |= level.chunks[at].astype(np.uint32) << np.uint32(8 * shift)
            if level.bits is None:
                break
            more = level.goes_on(at)
            at, held = level.rank(at[more]), held[more]
        return out

    def document(self, i: int) -> np.ndarray:
        return self.tokens(np.arange(self.starts[i], self.starts[i + 1]))


def write_tokens(
    df: DataFrame,
    path: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int = 0,
    tokenizer: str = TOKENIZER,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode every whole text, append ``end_id`` and write all ids in ascending order of ``key``.

    Every file of ``path`` is one segment of about ``segment_tokens`` ids; documents are not cut, so
    a longer one has a longer segment. A null text is the end id alone, null keys come first, rows
    that share a key stay apart, an empty table gives no segment. ``tokenizer`` is a file
    that every executor can open.
    """
    spark = df.sparkSession
    base = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = min(MOST_TASKS, max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism))
    # texts are put in order before they are encoded: ranges are sampled from the keys without encoding twice
    numbered = base.withColumn("row", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange(tasks, "key", "row").sortWithinPartitions("key", "row").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, coder = TaskContext.get().partitionId(), 0, byte_tokenizer(tokenizer)
        end = np.array([end_id], np.uint32)
        held, keys, starts = [], [], [0]

        def segment() -> pa.RecordBatch:
            blob = Segment.pack(np.concatenate(held), keys, starts, task, number)
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["segment"])

        for batch in batches:
            for part in by_bytes(batch):
                for name, ids in zip(part.column("key").to_pylist(), coder.encode(part.column("text")), strict=True):
                    if held and starts[-1] + len(ids) + 1 > segment_tokens:
                        yield segment()
                        held, keys, starts, number = [], [], [0], number + 1
                    held += [ids, end]
                    keys.append(name)
                    starts.append(starts[-1] + len(ids) + 1)
        if held:
            yield segment()

    # a text file of one record is the record and a line end, which the segment's own sizes make harmless
    segments = ship(ordered).mapInArrow(run, "segment binary").select(F.col("segment").cast("string"))
    segments.write.option("maxRecordsPerFile", 1).text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the files of ``path``.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is the unsigned CRC-32 of its
    ids as little-endian unsigned 32-bit integers. One row per segment is summed in one task.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    names = ["task", "number", "local", "key", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                segment = Segment(content.as_buffer())
                n = len(segment.keys)
                crc = [zlib.crc32(segment.document(i).astype("<u4").tobytes()) for i in range(n)]
                arrays = [
                    pa.array(np.full(n, segment.task, np.int64)),
                    pa.array(np.full(n, segment.number, np.int64)),
                    pa.array(segment.starts[:-1]),
                    pa.array(segment.keys, mask=segment.has_key == 0),
                    pa.array(np.diff(segment.starts)),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = materialise(ship(files).mapInArrow(run, ", ".join(f"{c} long" for c in names)))
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    segments = rows.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))
    bases = segments.select("task", "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.join(broadcast_if_small(bases), ["task", "number"])
    return placed.select("key", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
