"""Collocations from pair tiles of frequency-ranked ids.

Texts become chunks: streams of word ids with gaps between pieces. Ids are ranks by frequency, so
the pairs of frequent words lie in few square tiles of the table of all pairs. Inside a chunk,
tiles that hold many pairs are counted by direct address in a dense array, all others as sorted
coordinates; the chunks' counts are then added up by pair, which no frequent pair can crowd.

Pairs found often enough are ranked and numbered like words, the streams rewritten in their ids, and
counted again: two neighbouring pairs are a phrase of three words, and so on. Nothing is lost by
leaving rare words and pairs out, as no phrase is more frequent than its parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pledgeflow.llm.text_batches import packed, ship, text_bytes, unpacked
from pledgeflow.operators.ordering import running_total
from pledgeflow.session import broadcast_if_small, materialise

MIN_COUNT, MAX_WORDS, TOP, COVERED_PERCENT, SCALE = 10, 3, 2000, 50, 1_000_000
# text bytes of a chunk (one text at least), rows of an Arrow batch sent back
CHUNK_BYTES, BATCH_ROWS = 8 << 20, 1 << 16
# ids along a tile, tiles along the square that may be dense, and pairs a cell of a dense tile
SIDE, HEAD, FILLED = 256, 32, 4
_WORD, _BLANK, _BREAK = range(3)
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b" \t")] = _BLANK
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK


def word_codes(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Codes of a text's lowered words in order, 0 between pieces, and the distinct words (code 1 first)."""
    byte = np.frombuffer(raw.lower(), np.uint8)
    kind = _CLASS[byte]
    inside = kind == _WORD
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    letters = byte[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, len(letters)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
    breaks = np.concatenate([[0], piece[1:] != piece[:-1]]).cumsum()
    codes = np.zeros(len(starts) + int(breaks[-1]), np.int32)
    codes[np.arange(len(starts)) + breaks] = words.indices.to_numpy(zero_copy_only=False) + 1
    return codes, words.dictionary


def text_chunks(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(chunk, lang, codes, words, counts) of about ``CHUNK_BYTES`` of texts of one language, written once."""
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    base = df.select(language, F.col(text).cast("string").alias("text"))
    names = ["chunk", "lang", "codes", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 36, {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for name, texts in held.items():
                codes, words = word_codes(b"\n".join(texts))
                counts = np.bincount(codes, minlength=len(words) + 1)[1:]
                if len(words):
                    lists = [pa.ListArray.from_arrays([0, len(words)], x) for x in (words, pa.array(counts, pa.int64()))]
                    arrays = [pa.array([number], pa.int64()), pa.array([name]), pa.array([packed(codes)], pa.binary()), *lists]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                number += 1

        for batch in batches:
            for name, raw in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text")), strict=True):
                held.setdefault(name, []).append(raw)
                size += len(raw) + 1
                if size >= CHUNK_BYTES:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    schema = "chunk long, lang string, codes binary, words array<string>, counts array<long>"
    return materialise(ship(base).mapInArrow(run, schema))


def tile_counts(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of positions in ``ids`` (ascending global ids) with their counts."""
    x, y = ids[first], ids[second]
    base = ids[0] // SIDE * SIDE  # a language's ids follow each other
    row, col = (x - base) // SIDE, (y - base) // SIDE
    tile = np.where((row < HEAD) & (col < HEAD), row * HEAD + col, HEAD * HEAD)
    filled = np.bincount(tile, minlength=HEAD * HEAD + 1)[:-1] * FILLED >= SIDE * SIDE
    dense = np.flatnonzero(filled)
    place = np.full(HEAD * HEAD + 1, -1)
    place[dense] = np.arange(len(dense))
    at = place[tile]
    held = at >= 0
    cell = (at[held] * SIDE + (x[held] - base) % SIDE) * SIDE + (y[held] - base) % SIDE
    counts = np.bincount(cell, minlength=len(dense) * SIDE * SIDE)
    full = np.flatnonzero(counts)
    of = dense[full // (SIDE * SIDE)]
    dense_x = base + of // HEAD * SIDE + full // SIDE % SIDE
    dense_y = base + of % HEAD * SIDE + full % SIDE
    key = np.sort(first[~held].astype(np.int64) * len(ids) + second[~held])
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    pairs = key[new]
    out_x, out_y = np.concatenate([dense_x, ids[pairs // len(ids)]]), np.concatenate([dense_y, ids[pairs % len(ids)]])
    return out_x, out_y, np.concatenate([counts[full], np.diff(np.append(new, len(key)))])


def _neighbours(codes: np.ndarray) -> np.ndarray:
    """Positions whose code and the next one's are both there."""
    return np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))


def pair_counts(streams: DataFrame) -> DataFrame:
    """(chunk, first, second, n): neighbouring ids of every chunk of (chunk, codes, ids)."""
    names = ["chunk", "first", "second", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, codes, ids in zip(*(batch.column(c) for c in ("chunk", "codes", "ids")), strict=True):
                codes, ids = unpacked(codes, True), unpacked(ids, True)
                at = _neighbours(codes)
                if not len(at):
                    continue
                first, second, n = tile_counts(codes[at] - 1, codes[at + 1] - 1, ids)
                for low in range(0, len(n), BATCH_ROWS):
                    part = [x[low : low + BATCH_ROWS] for x in (first, second, n)]
                    arrays = [pa.array(np.full(len(part[0]), chunk.as_py(), np.int64)), *[pa.array(x, pa.int64()) for x in part]]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return ship(streams.select("chunk", "codes", "ids")).mapInArrow(run, "chunk long, first long, second long, n long")


def _stream(chunk: pa.Array, codes: np.ndarray, found: np.ndarray, ids: np.ndarray) -> pa.Table:
    """One stream: ``codes`` (0 or positions from 1 in ``found``) renumbered by ascending id, without ids that don't occur."""
    order = np.argsort(ids, kind="stable")
    table = np.zeros(int(found.max(initial=0)) + 1, np.int32)
    table[found[order]] = np.arange(1, len(order) + 1)
    codes = np.where(codes < len(table), codes, 0)
    cells = (table[codes], ids[order].astype(np.int64))
    arrays = [chunk, *[pa.array([packed(x)], pa.binary()) for x in cells]]
    return pa.table(arrays, names=["chunk", "codes", "ids"])


_STREAM = "chunk long, codes binary, ids binary"


def _empty_stream() -> pa.Table:
    return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["chunk", "codes", "ids"])


def word_streams(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """Streams of the ids of ``words`` (id, lang, phrase); other words are gaps."""
    local = chunks.select("chunk", "lang", F.posexplode("words").alias("at", "phrase"))
    known = local.join(words.select("id", "lang", "phrase"), ["lang", "phrase"]).select(F.col("chunk").alias("of"), (F.col("at") + 1).alias("code"), "id")

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _empty_stream()
        codes = unpacked(left.column("codes")[0], True)
        found, ids = right.column("code").to_numpy(), right.column("id").to_numpy()
        return _stream(left.column("chunk").combine_chunks(), codes, found, ids)

    return materialise(ship(chunks.select("chunk", "codes")).groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(rewrite, _STREAM))


def pair_streams(streams: DataFrame, known: DataFrame) -> DataFrame:
    """Streams of the ids of ``known`` (of, first, second, id): a pair stands where it begins."""

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _empty_stream()
        codes = unpacked(left.column("codes")[0], True)
        ids = unpacked(left.column("ids")[0], True)
        first, second = (np.searchsorted(ids, right.column(c).to_numpy()) for c in ("first", "second"))
        keys = first * len(ids) + second
        order = np.argsort(keys)
        keys, at = keys[order], _neighbours(codes)
        here = (codes[at].astype(np.int64) - 1) * len(ids) + codes[at + 1] - 1
        place = np.minimum(np.searchsorted(keys, here), len(keys) - 1)
        out = np.zeros(len(codes), np.int32)
        out[at] = np.where(keys[place] == here, place + 1, 0)
        return _stream(left.column("chunk").combine_chunks(), out, np.arange(1, len(keys) + 1), right.column("id").to_numpy()[order])

    return materialise(ship(streams).groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(rewrite, _STREAM))


def _numbered(phrases: DataFrame) -> DataFrame:
    """``id`` added: rank from 1 by language, falling frequency and phrase."""
    return running_total(phrases.withColumn("rarity", -F.col("n")), ["lang", "rarity", "phrase"], out="id").drop("rarity")


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS):
    """(phrases, totals): phrases of 1 to ``max_words`` words as (lang, phrase, size, n), and words in all as (lang, n)."""
    chunks = text_chunks(df, text, lang)
    words = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("phrase"))
    words = words.agg(F.sum("w.counts").alias("n")).filter(F.col("n") >= min_count)
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    totals = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    level, found, streams, known = materialise(_numbered(words)), [], None, None
    for size in range(1, max_words + 1):
        found.append(level.select("lang", "phrase", F.lit(size).alias("size"), "n"))
        if size == max_words:
            break
        streams = word_streams(chunks, level) if size == 1 else pair_streams(streams, known)
        # counted anew where it is needed again: that costs less than keeping a row of every pair of a chunk
        counted = pair_counts(streams)
        pairs = counted.groupBy("first", "second").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
        left = level.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("start"))
        right = level.select(F.col("id").alias("second"), F.substring_index("phrase", " ", -1).alias("last"))
        named = pairs.join(left, "first").join(right, "second").select("lang", F.concat_ws(" ", "start", "last").alias("phrase"), "n", "first", "second")
        level = materialise(_numbered(named) if size + 1 < max_words else named)
        if size + 1 < max_words:
            known = counted.select(F.col("chunk").alias("of"), "first", "second")
            known = known.join(level.select("first", "second", "id"), ["first", "second"])
    return reduce(DataFrame.unionByName, found), totals


def _span(words, first, last):
    return F.array_join(F.slice(words, first, last), " ")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs of characters other than blanks and tabs, A-Z lowered, inside pieces that end at
    ``.,;:!?`` and line ends. A phrase of 2 to ``max_words`` words found ``a >= min_count`` times (overlaps
    included) is cut after each of its words into parts found l and r times; its score is the lowest
    floor(1,000,000 a a / (l r)), ties to the first cut. A phrase goes if a longer one that contains it
    has at least ``covered_percent`` percent of its count. n counts all words of the language. Order:
    score and a falling, then the phrase by its UTF-8 bytes.

    A null language is ``und``; null, empty and blank texts have no words; repeated rows count each
    time; other columns are not read; an empty table gives no rows. A text is never cut, so one longer
    than a chunk is a chunk of its own.
    """
    phrases, totals = frequent_phrases(df, text, lang, min_count, max_words)
    counts = materialise(phrases)
    long = counts.filter("size >= 2").withColumn("words", F.split("phrase", " "))
    size = F.col("size")
    cuts = long.select("lang", "phrase", "size", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _span(F.col("words"), F.lit(1), F.col("k")), "right": _span(F.col("words"), F.col("k") + 1, size - F.col("k"))})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.call_function("div", wide["a"] * wide["a"] * F.lit(SCALE).cast("decimal(7,0)"), wide["l"] * wide["r"])
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    parts = F.array(_span(F.col("words"), F.lit(1), size - 1), _span(F.col("words"), F.lit(2), size - 1))
    cover = long.filter("size >= 3").select("lang", F.explode(parts).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = scored.join(cover, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(broadcast_if_small(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score")
    )
