"""Arrow batches of texts for operators that need a Python library per document."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_ARCHIVE = "pledgeflow_package.zip"
# most bytes of an Arrow batch (of one row at least); a worker holds a few batches at once
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship(df: DataFrame) -> DataFrame:
    """Give this package to the executors, once per context, and return ``df``.

    Functions then reach Python workers by name, so their memos outlive a task. The session's
    Arrow batches are held to ``BATCH_BYTES``, as a batch of long texts grows with the texts.
    """
    session = df.sparkSession
    as_bytes = session._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if not 0 < as_bytes(session.conf.get(_BATCH)) <= BATCH_BYTES:
        session.conf.set(_BATCH, f"{BATCH_BYTES}b")
    context = session.sparkContext
    if _ARCHIVE not in context._python_includes:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), _ARCHIVE)
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
    return df


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, one at a time; empty for null."""
    for text in column.cast(pa.large_binary()):
        yield text.as_py() or b""


def packed(values: np.ndarray) -> bytes:
    """Integers as their width, their number of bytes and compressed bytes."""
    raw = values.tobytes()
    head = values.itemsize.to_bytes(1, "little") + len(raw).to_bytes(8, "little")
    return head + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(held: pa.BinaryScalar, signed: bool = False) -> np.ndarray:
    """Integers of a cell that :func:`packed` made."""
    raw = memoryview(held.as_buffer())
    size = int.from_bytes(raw[1:9], "little")
    plain = pa.Codec("zstd").decompress(raw[9:], decompressed_size=size) if size else b""
    return np.frombuffer(plain, f"<{'i' if signed else 'u'}{raw[0]}")


def map_texts(
    df: DataFrame,
    text: str,
    passed: Sequence[str],
    fields: Sequence[tuple[str, T.DataType, pa.DataType]],
    rows_of: Callable[[bytes], Sequence[tuple]],
) -> DataFrame:
    """Rows of ``passed`` columns and ``fields``, for every tuple that ``rows_of`` gives a text.

    A null text is passed as empty bytes. The passed columns travel as one struct, so that
    field names cannot clash with theirs; it is returned as ``kept``.
    """
    base = df.select(F.struct(*[F.col(c) for c in passed]).alias("kept"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([base.schema["kept"]])
    for name, kind, _ in fields:
        schema.add(name, kind)
    names = ["kept", *[name for name, _, _ in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, source, columns = batch.column("kept"), [], [[] for _ in fields]
            for i, raw in enumerate(text_bytes(batch.column("text"))):
                for row in rows_of(raw):
                    source.append(i)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            arrays = [pa.array(c, kind) for c, (_, _, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([kept.take(pa.array(source, pa.int32())), *arrays], names=names)

    return ship(base).mapInArrow(run, schema)
