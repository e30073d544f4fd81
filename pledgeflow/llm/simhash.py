"""SimHash near-duplicates by pivot distance tables.

Distinct fingerprints meet where they agree on enough blocks of bits for a link to be possible.
There, the Hamming distances of every fingerprint to a table of reference fingerprints are
computed once; by the triangle inequality two fingerprints whose distances to any reference
differ by more than the radius can't be linked, and only the survivors are verified. Large
meeting groups are walked from member to member, so that links, not pairs, leave a task; members of
crowded ones meet anew under longer keys.
Links become components by alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship, text_bytes
from pledgeflow.session import materialise

SEED, BITS = 42, 64
# reference fingerprints; groups above this size are walked; shingle hashes counted at once
PIVOTS, SMALL_GROUP, HASHES_AT_ONCE = 16, 48, 1 << 16
# fingerprints that may share a meeting key by chance before longer keys are taken
CHANCE = 64
# members of a key above which they meet anew under longer keys, and how often
CROWDED, REFINEMENTS = 1 << 10, 3


def fingerprint(raw: bytes, words: int = 4) -> bytes:
    """Big-endian fingerprint of a UTF-8 text: XXH64 of its shingles of lowered words.

    Repeated shingles count each time; a text of fewer words is one shingle; one without
    words has fingerprint zero.
    """
    tokens = raw.lower().split()
    if not tokens:
        return bytes(BITS // 8)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(words, len(tokens)) - 1
    starts, ends = starts[: len(starts) - span].tolist(), ends[span:].tolist()
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_digest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        cut = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in cut]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, BITS // 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(starts)).tobytes()


def fingerprints(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",), words: int = 4) -> DataFrame:
    """``kept`` (struct of passed columns), ``row`` (unique) and signed 64-bit ``print``, written once."""
    inner = text in passed
    own = [] if inner else [F.col(text).cast("string").alias("text")]
    base = df.select(F.struct(*[F.col(c) for c in passed]).alias("kept"), *own)
    schema = T.StructType([base.schema["kept"]]).add("row", T.LongType()).add("print", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            kept = batch.column("kept")
            texts = kept.field(text) if inner else batch.column("text")
            prints = [int.from_bytes(fingerprint(raw, words), "big", signed=True) for raw in text_bytes(texts)]
            numbers = pa.array(range(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([kept, numbers, pa.array(prints, pa.int64())], names=["kept", "row", "print"])

    return materialise(ship(base).mapInArrow(run, schema))


def block_masks(radius: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` among ``radius + agree`` blocks of bits.

    Fingerprints at most ``radius`` bits apart differ in at most ``radius`` blocks, so they are
    equal under one mask at least.
    """
    blocks = radius + agree
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, agree)]


def _agreement(distinct: int, radius: int) -> int:
    """Blocks that must agree so that few unlinked fingerprints meet; results don't depend on it."""
    agree = 2
    while agree < 4 and distinct > CHANCE << (BITS * agree // (radius + agree)):
        agree += 1
    return agree


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(prints: DataFrame, radius: int = 4, agree: int | None = None) -> DataFrame:
    """(a, b): links that connect all of the distinct ``prints`` that are at most ``radius`` bits apart.

    Every linked pair is connected, directly or through others; a pair may come from several masks.
    Keys with more than ``CROWDED`` members are left to a search among those members in which one
    more block has to agree, which is as complete; the last search takes every key.
    """
    agree, found = agree or _agreement(prints.count(), radius), []
    for last in (False,) * REFINEMENTS + (True,):
        met = materialise(_met(prints, radius, agree, last))
        found.append(met.filter("b is not null"))
        prints, agree = materialise(met.filter("b is null").select(F.col("a").alias("print")).distinct()), agree + 1
        if not prints.limit(1).count():
            break
    return reduce(DataFrame.unionByName, found).distinct()


def _met(prints: DataFrame, radius: int, agree: int, last: bool) -> DataFrame:
    """Links (a, b) between prints that agree on ``agree`` blocks, and (a, null) for members of crowded keys."""
    masks = block_masks(radius, agree)
    keys = F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "key")
    met = prints.select("print", keys).repartition("mask", "key").sortWithinPartitions("mask", "key", "print")
    pivots = np.random.default_rng(SEED).integers(0, 1 << 63, PIVOTS, np.uint64) * np.uint64(2) + np.uint64(1)

    def alone(values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values), pa.nulls(len(values), pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # complete groups are linked; what is held is the last, unfinished one, and no more of it than makes it crowded
        held, crowded = np.zeros((3, 0), np.int64), None
        for batch in batches:
            mask, key, value = (batch.column(c).to_numpy() for c in ("mask", "key", "print"))
            rows = np.concatenate([held, np.stack([mask.astype(np.int64), key, value])], axis=1)
            if crowded is not None:
                more = int(np.argmin(np.append((rows[0] == crowded[0]) & (rows[1] == crowded[1]), False)))
                yield alone(rows[2, :more])
                crowded, rows = crowded if more == rows.shape[1] else None, rows[:, more:]
            new = np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])) if rows.shape[1] else np.zeros(0, np.int64)
            sizes = np.diff(np.append(new, rows.shape[1]))
            large = (sizes > CROWDED) & (not last)
            yield alone(rows[2, np.repeat(large, sizes)])
            if len(large) and large[-1]:
                crowded = rows[0, -1], rows[1, -1]
            stays = np.repeat(~large, sizes)
            cut = int(new[-1]) if len(new) else 0
            yield from _link_batches(rows[:, :cut][:, stays[:cut]], pivots, radius)
            held = rows[:, cut:][:, stays[cut:]]
        yield from _link_batches(held, pivots, radius)

    return ship(met).mapInArrow(run, "a long, b long")


def _link_batches(rows: np.ndarray, pivots: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside complete groups of rows (mask, key, print), sorted by group."""
    if not rows.shape[1]:
        return
    new = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(np.append(first, rows.shape[1]))
    met = sizes[group] > 1
    if not met.any():
        return
    values = np.ascontiguousarray(rows[2]).view(np.uint64)
    table = np.zeros((len(values), len(pivots)), np.int8)
    table[met] = np.bitwise_count(values[met, None] ^ pivots[None, :])
    small = np.flatnonzero(met & (sizes[group] <= SMALL_GROUP))
    a, b = _small_links(values[small], group[small], table[small], radius)
    found = [(a, b)]
    for at in np.flatnonzero(sizes > SMALL_GROUP).tolist():
        span = slice(first[at], first[at] + sizes[at])
        found.append(_walk(values[span], table[span], radius))
    for a, b in found:
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])


def _small_links(values, group, table, radius):
    """Links between rows of one group, by shifting the sorted rows against themselves."""
    a, b, shift = [values[:0]], [values[:0]], 1
    while shift < len(values):
        left = np.flatnonzero(group[shift:] == group[:-shift])
        if not len(left):
            break
        near = (np.abs(table[left] - table[left + shift]) <= radius).all(axis=1)
        left = left[near]
        left = left[np.bitwise_count(values[left] ^ values[left + shift]) <= radius]
        a.append(values[left])
        b.append(values[left + shift])
        shift += 1
    return np.concatenate(a), np.concatenate(b)


def _walk(values, table, radius):
    """Links of a spanning forest of one large group: each member is compared with those not yet reached."""
    a, b, rest = [values[:0]], [values[:0]], np.arange(len(values))
    while len(rest):
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            member = waiting.pop()
            reached = (np.abs(table[rest] - table[member]) <= radius).all(axis=1)
            reached[reached] = np.bitwise_count(values[rest[reached]] ^ values[member]) <= radius
            near, rest = rest[reached], rest[~reached]
            a.append(np.full(len(near), values[member]))
            b.append(values[near])
            waiting.extend(near.tolist())
    return np.concatenate(a), np.concatenate(b)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) links, by alternating large and small stars.

    Minima are aggregated map-side and joined back, so a node with very many links is never
    one task's group. Each round is written, which also cuts the lineage.
    """
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = materialise(edges.select(high, low).filter("a <> b").distinct())
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialise(down.filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    passed: Sequence[str] = (),
    words: int = 4,
    radius: int = 4,
) -> DataFrame:
    """``kept`` (struct of key and passed columns), ``row``, ``print``, ``root`` and ``component_id``.

    Documents whose fingerprints are at most ``radius`` bits apart are linked; ``root`` names the
    component by a fingerprint, ``component_id`` is its smallest key. A null or empty text has
    fingerprint zero, linked like any other; null keys are left out of the smallest key, which is
    null if there is no other; repeated rows share a fingerprint; an empty table gives no rows.
    """
    printed, labels = _labelled(df, text, key, passed, words, radius)
    return printed.join(labels, "print").select("kept", "row", "print", "root", "component_id")


def _labelled(df: DataFrame, text: str, key: str, passed: Sequence[str], words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprinted documents, and root and component of each fingerprint."""
    printed = fingerprints(df, text, list(dict.fromkeys([key, *passed])), words)
    by_print = materialise(printed.groupBy("print").agg(F.min(F.col("kept").getField(key)).alias("least")))
    joined = materialise(components(links(by_print.select("print"), radius)))
    labels = by_print.join(joined.withColumnRenamed("node", "print"), "print", "left")
    labels = labels.select("print", "least", F.coalesce("root", "print").alias("root"))
    merged = labels.join(joined.select("root").distinct(), "root", "left_semi")
    merged = merged.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labels.join(merged, "root", "left").select("print", "root", F.coalesce("component_id", "least").alias("component_id"))
    return printed, materialise(labels)


def representatives(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, radius: int = 4) -> DataFrame:
    """One document of each component: the one with its smallest key, with all columns of ``df``.

    Of rows that share that key one stays. Null keys come last. Texts are shuffled once at most.
    """
    printed, labels = _labelled(df, text, key, df.columns, words, radius)
    name = F.col("kept").getField(key)
    rank = F.struct(name.isNull(), name, F.col("row"))
    narrow = printed.select("print", "row", rank.alias("rank")).join(labels, "print")
    chosen = narrow.groupBy("root").agg(F.min("rank").getField("row").alias("row")).select("row")
    return printed.join(chosen, "row", "left_semi").select("kept.*")
