"""Product codes of integer vectors through per-dimension value dictionaries.

Vectors become integers and are laid out in chunks of columns: every dimension of a chunk has a
dictionary of its distinct values and an index into it for each vector. To find nearest entries,
the squared differences of all dictionary values to all entries are tabulated once a chunk; the
distances of a part are then gathers from these tables by index, added over its dimensions.

Codebooks are fitted on all vectors. A round reads the chunks, sums parts by nearest entry inside
each task and brings home one number for each entry and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship
from pledgeflow.session import broadcast_if_small, materialise

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# vectors in a chunk at most; larger integers would not leave room for sums of squares in 64 bits
CHUNK_ROWS, LARGEST = 1 << 15, 1 << 26


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def fitting(vector: Column, dims: int, scale: int) -> Column:
    """Whether a usable vector has ``dims`` components whose integers leave room for the arithmetic."""
    return (F.size(vector) == dims) & F.forall(vector, lambda x: F.abs(x) * scale < LARGEST)


def common_length(df: DataFrame, vector: str) -> int:
    """The most frequent vector length, the larger one of equals; 0 for an empty table."""
    lengths = df.groupBy(F.size(vector).alias("dims")).agg(F.count("*").alias("n"))
    found = lengths.agg(F.max(F.struct("n", "dims")).alias("most")).first()["most"]
    return found["dims"] if found else 0


def part_edges(dims: int, parts: int) -> list[int]:
    """First dimension of each part, and the end; parts are equal if ``parts`` divides ``dims``."""
    return [dims * i // parts for i in range(parts + 1)]


def chunked(df: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """Chunks of at most ``CHUNK_ROWS`` rows of (kept, vector), written once.

    ``kept`` (the rows' structs), ``widths`` (distinct values of each dimension), ``values`` (those
    values, 32-bit, ascending within a dimension) and ``codes`` (16-bit indexes, dimension by dimension).
    """
    base = df.select("kept", F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"))
    schema = T.StructType().add("kept", T.ArrayType(base.schema["kept"].dataType)).add("widths", T.ArrayType(T.IntegerType()))
    schema.add("values", T.BinaryType()).add("codes", T.BinaryType())

    def chunk(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        kept = pa.concat_arrays(table.column("kept").chunks)
        flat = pa.concat_arrays(table.column("vector").chunks).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(kept), dims)
        found = [np.unique(vectors[:, d], return_inverse=True) for d in range(dims)]
        values = b"".join(v.astype("<i4").tobytes() for v, _ in found)
        codes = b"".join(c.astype("<u2").tobytes() for _, c in found)
        lists = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
        widths = pa.array([[len(v) for v, _ in found]], pa.list_(pa.int32()))
        arrays = [lists, widths, pa.array([values], pa.binary()), pa.array([codes], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                if n + part.num_rows > CHUNK_ROWS:
                    yield chunk(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield chunk(held)

    return materialise(ship(base).mapInArrow(run, schema))


class Chunk:
    """Dictionaries and indexes of one chunk."""

    def __init__(self, widths: Sequence[int], values: bytes, codes: bytes):
        ends = np.cumsum(widths)
        held = np.frombuffer(values, "<i4").astype(np.int64)
        self.values = np.split(held, ends[:-1])
        self.codes = np.frombuffer(codes, "<u2").reshape(len(widths), -1)

    def part_distances(self, book: np.ndarray, first: int, last: int) -> np.ndarray:
        """Squared distances of all rows to all entries of one part's ``book`` (entries x dimensions)."""
        total = np.zeros((self.codes.shape[1], len(book)), np.int64)
        for d in range(first, last):
            table = (self.values[d][:, None] - book[None, :, d - first]) ** 2
            total += table[self.codes[d]]
        return total

    def nearest(self, books: Sequence[np.ndarray], edges: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index and squared distance of each part's nearest entry, the lowest index of equals."""
        for book, first, last in zip(books, edges, edges[1:], strict=False):
            distances = self.part_distances(book, first, last)
            index = distances.argmin(axis=1)
            yield index, distances[np.arange(len(index)), index]


def _round(chunks: DataFrame, books: Sequence[np.ndarray], edges: Sequence[int]) -> list[np.ndarray]:
    """Every entry replaced by the floor of the mean of the parts nearest to it; unused ones stay."""
    dims, entries = edges[-1], len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(books), entries), np.int64)
        sums = np.zeros((dims, entries), object)
        for batch in batches:
            for widths, values, codes in zip(*(batch.column(c) for c in ("widths", "values", "codes")), strict=True):
                chunk = Chunk(widths.as_py(), values.as_py(), codes.as_py())
                for part, (index, _) in enumerate(chunk.nearest(books, edges)):
                    counts[part] += np.bincount(index, minlength=entries)
                    for d in range(edges[part], edges[part + 1]):
                        # below 2^15 rows of 2^26: exact in doubles
                        found = np.bincount(index, chunk.values[d][chunk.codes[d]], entries)
                        sums[d] += found.astype(np.int64).astype(object)
        # rows (part, entry, -1, count) and (part, entry, dimension, sum); sums as text, as they may pass 64 bits
        rows = [(p, e, -1, str(counts[p, e])) for p in range(len(books)) for e in range(entries) if counts[p, e]]
        rows += [
            (p, e, d, str(sums[d, e])) for p in range(len(books)) for d in range(edges[p], edges[p + 1]) for e in range(entries) if counts[p, e]
        ]
        if rows:
            part, entry, dim, n = zip(*rows, strict=True)
            arrays = [pa.array(x, pa.int32()) for x in (part, entry, dim)] + [pa.array(n, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "dim", "n"])

    totals = ship(chunks.select("widths", "values", "codes")).mapInArrow(run, "part int, entry int, dim int, n string")
    found = totals.groupBy("part", "entry", "dim").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    counts = {(r["part"], r["entry"]): int(r["n"]) for r in found if r["dim"] < 0}
    new = [book.copy() for book in books]
    for r in found:
        if r["dim"] >= 0:
            part, entry = r["part"], r["entry"]
            new[part][entry, r["dim"] - edges[part]] = int(r["n"]) // counts[part, entry]
    return new


def first_books(rows: DataFrame, key: str, dims: int, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """Codebooks cut from the vectors of the ``entries`` smallest keys (null keys last, ties by vector)."""
    name = F.col("kept").getField(key)
    first = rows.select(name.alias("name"), F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"))
    first = first.orderBy(F.col("name").asc_nulls_last(), "vector").limit(entries).collect()
    vectors = np.array([r["vector"] for r in first], np.int64).reshape(len(first), dims)
    edges = part_edges(dims, parts)
    return [vectors[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]


def digest(books: Sequence[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    passed: Sequence[str] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors, and the codebooks they refer to.

    Returns ``kept`` (struct of key and passed columns), ``code`` (the parts' entry indexes, two hex digits
    each) and ``error`` (squared distances to those entries, summed over parts). Components
    become ``floor(scale * x)``; each part's codebook starts as that part of the vectors with the
    ``entries`` smallest keys and is refined ``rounds`` times on all vectors.

    Vectors that are null or hold null or non-finite components give no row. A vector whose length
    is not the table's most frequent one, or whose integers reach 2^26, can't be compared with the
    others: it takes no part, and its code and error are null. Empty vectors have empty parts,
    index 0 and error 0. Null keys come last among the first entries; repeated rows count each
    time; with fewer vectors than ``entries`` there are as many entries; an empty table gives no rows.
    """
    kept = F.struct(*[F.col(c) for c in dict.fromkeys([key, *passed])]).alias("kept")
    rows = df.select(kept, F.col(vector).alias("vector")).filter(usable(F.col("vector")))
    dims = common_length(rows, "vector")
    fits = fitting(F.col("vector"), dims, scale)
    books = first_books(rows.filter(fits), key, dims, parts, entries, scale)
    edges = part_edges(dims, parts)
    outside = rows.filter(~fits).select("kept", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not len(books[0]):
        return outside, books
    if not dims:
        return rows.filter(fits).select("kept", F.lit("00" * parts).alias("code"), F.lit(0).cast("long").alias("error")).unionByName(outside), books
    chunks = chunked(rows.filter(fits), "vector", dims, scale)
    for _ in range(rounds):
        books = _round(chunks, books, edges)
    schema = T.StructType().add("kept", rows.schema["kept"].dataType).add("code", T.StringType()).add("error", T.LongType())
    final = books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                widths, values, codes = (batch.column(c)[i].as_py() for c in ("widths", "values", "codes"))
                index, error = zip(*Chunk(widths, values, codes).nearest(final, edges), strict=True)
                hexed = np.stack(index, axis=1).astype(np.uint8).tobytes().hex()
                shown = [hexed[at : at + 2 * parts] for at in range(0, len(hexed), 2 * parts)]
                arrays = [batch.column("kept")[i].values, pa.array(shown, pa.string()), pa.array(sum(error), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    coded = ship(chunks).mapInArrow(run, schema)
    return coded.unionByName(outside), books


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """``label_error`` added: the error summed over equal labels of ``kept``, nulls together."""
    coded = materialise(coded)
    name = F.col("kept").getField(label)
    totals = coded.groupBy(name.alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(broadcast_if_small(totals), name.eqNullSafe(F.col("__label")), "left").drop("__label")
