"""Quality rules with an isolation forest on rule statistics.

Two fixed rules reject documents that are too short or repeat themselves. For the rest an
isolation forest, grown on a bounded sample of distinct statistics, gives a path length over
random splits; documents isolated sooner than a threshold are rejected. The threshold is the
one that catches most labelled low-quality documents while it loses at most a stated share of
the good ones.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship, text_bytes
from pledgeflow.session import materialise

SYMBOLS, SPACE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
# forest: trees and statistics per tree (together the bound of the sample), and its seed
TREES, SAMPLE, SEED = 100, 256, 11
# what a word in a repeated window and a duplicate line take from the variety of words
REPEAT_WEIGHT, DUP_LINE_WEIGHT = 0.05, 1.0
# share of good labelled documents that the threshold may lose, and bins of the score's histogram
MAX_LOSS, SCORE_BINS = 0.002, 10_000
_ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], np.uint64)


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside windows of eight words that the text holds twice or more, the first included."""
    windows = len(words) - WINDOW + 1
    if windows < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(windows, np.uint64)
    for k, factor in enumerate(_ODD):
        rolled += hashes[k : k + windows] * factor
    order = np.argsort(rolled)
    same = np.diff(rolled[order].view(np.int64)) == 0
    if not same.any():
        return 0
    maybe = np.sort(order[np.append(same, False) | np.append(False, same)]).tolist()
    texts = [b" ".join(words[i : i + WINDOW]) for i in maybe]
    times = Counter(texts)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, window in zip(maybe, texts, strict=True):
        if times[window] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def text_counts(raw: bytes) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one UTF-8 text; words are runs of anything but ASCII white space."""
    words = raw.split()
    white = sum(raw.count(c) for c in SPACE)
    characters = len(raw) if raw.isascii() else len(raw.decode())
    symbols = sum(raw.count(c) for c in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), characters - white, symbols, len(lines) - len(set(lines)), repeated_words(words), len(set(words))


def rule_statistics(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``kept`` (struct of passed columns) and ``COUNTS`` of every whole text, written once.

    A null or empty text has no words.
    """
    inner = text in passed
    own = [] if inner else [F.col(text).cast("string").alias("text")]
    base = df.select(F.struct(*[F.col(c) for c in passed]).alias("kept"), *own)
    schema = T.StructType([base.schema["kept"], *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept")
            texts = kept.field(text) if inner else batch.column("text")
            rows = np.array([text_counts(raw) for raw in text_bytes(texts)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([kept, *map(pa.array, rows.T)], names=["kept", *COUNTS])

    return materialise(ship(base).mapInArrow(run, schema))


def base_failed() -> Column:
    """The fixed rules: fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> list[Column]:
    """Statistics the forest splits on: symbols per word, word length, variety of words.

    Variety is the log of distinct words over the log of all words, which hardly falls with the
    length of clean text as their plain ratio does, less what the rules count as repetition:
    words in repeated windows and duplicate lines, per word. Both are zero in most texts, so as
    features of their own every text with a repeated line, good ones too, would be isolated.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))
    variety = F.log(F.greatest(F.col("n_distinct_words"), F.lit(1))) / F.log(F.greatest(F.col("n_words"), F.lit(3)))
    return [
        F.log1p(20 * F.col("n_symbols") / words),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        variety - REPEAT_WEIGHT * F.col("n_repeat_words") / words - DUP_LINE_WEIGHT * F.col("n_dup_lines") / words,
    ]


def mean_path(rows: int) -> float:
    """Mean path length of an unsuccessful search among ``rows`` values."""
    if rows < 3:
        return float(max(rows - 1, 0))
    return 2 * (math.log(rows - 1) + np.euler_gamma) - 2 * (rows - 1) / rows


def grow_tree(values: np.ndarray, seed: int, depth_limit: int) -> list[tuple[int, float, int, int, float]]:
    """Nodes (feature, split, left, right, path length); a leaf has feature -1."""
    rng, nodes, todo = np.random.default_rng(seed), [], [(values, 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        number = len(nodes)
        if parent >= 0:
            node = list(nodes[parent])
            node[2 + side] = number
            nodes[parent] = tuple(node)
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        usable = np.flatnonzero(high > low)
        if depth >= depth_limit or not len(usable):
            nodes.append((-1, 0.0, number, number, depth + mean_path(len(rows))))
            continue
        feature = int(rng.choice(usable))
        split = float(rng.uniform(low[feature], high[feature]))
        nodes.append((feature, split, -1, -1, 0.0))
        left = rows[:, feature] < split
        todo += [(rows[left], depth + 1, number, 0), (rows[~left], depth + 1, number, 1)]
    return nodes


def grow_forest(statistics: DataFrame, trees: int = TREES, sample: int = SAMPLE) -> list[np.ndarray]:
    """Trees grown as tasks on ``sample`` distinct statistics each: those first by the tree's own hash.

    Whole groups of equal statistics count once, so copies don't make junk look usual. A bound
    on the hash, twice as high as needed on average, thins a large table before the ranking.
    """
    point = F.array(*features()).alias("point")
    distinct = materialise(statistics.select(point).distinct())
    bound = F.lit(int(min(1.0, 2 * sample / max(distinct.count(), 1)) * (1 << 62)))

    def place(tree: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64("point", tree + F.lit(SEED)), 2)

    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    dealt = distinct.select(F.explode(F.filter(numbers, lambda tree: place(tree) <= bound)).alias("tree"), "point")

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ranked = sorted(zip(rows["place"], map(tuple, rows["point"]), strict=True))
        points = np.array([point for _, point in ranked[:sample]])
        nodes = grow_tree(points, SEED + int(key[0]), max(1, math.ceil(math.log2(max(sample, 2)))) + 2)
        frame = pd.DataFrame(nodes, columns=["feature", "split", "left", "right", "path"])
        return frame.assign(tree=int(key[0]), node=range(len(nodes)), rows=len(points))

    fields = "feature int, split double, left int, right int, path double, tree int, node int, rows int"
    placed = dealt.withColumn("place", place(F.col("tree")))
    grown = ship(placed).groupBy("tree").applyInPandas(grow, fields).toPandas().sort_values(["tree", "node"])
    return [g.drop(columns=["tree", "node"]).to_numpy(float) for _, g in grown.groupby("tree")]


def isolation(points: np.ndarray, forest: Sequence[np.ndarray]) -> np.ndarray:
    """Anomaly score of each row: near 1 where random splits isolate it early, below 0.5 where not."""
    if not len(forest):
        return np.zeros(len(points))
    paths = np.zeros(len(points))
    for tree in forest:
        feature, left, right = (tree[:, i].astype(np.int64) for i in (0, 2, 3))
        at = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            here = at[inner]
            below = points[inner, feature[here]] < tree[here, 1]
            at[inner] = np.where(below, left[here], right[here])
        paths += tree[at, 4]
    usual = max(np.mean([mean_path(int(tree[0, 5])) for tree in forest]), 1e-9)
    return 2.0 ** (-paths / len(forest) / usual)


def scored(statistics: DataFrame, forest: Sequence[np.ndarray]) -> DataFrame:
    """``statistics`` with the forest's ``score``."""
    shown = statistics.withColumn("point", F.array(*features()))
    schema = T.StructType([*statistics.schema.fields]).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            columns = [batch.column(name) for name in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(isolation(point, forest))], names=schema.names)

    return ship(shown).mapInArrow(run, schema)


def calibrated_threshold(rated: DataFrame, labels: DataFrame, key: str = "doc_id", max_loss: float = MAX_LOSS) -> float:
    """The lowest score bound that rejects at most ``max_loss`` of the good documents passing the rules.

    All labelled rows count, through a histogram of scores. A document with several labels is
    good if one says so. Without good or without bad labels nothing is rejected.
    """
    quality = labels.groupBy(F.col(key).alias("key")).agg(F.max("quality").alias("quality")).filter("quality is not null")
    bins = (
        rated.filter(~base_failed())
        .select(F.col("kept").getField(key).alias("key"), F.ceil(F.col("score") * SCORE_BINS).alias("bin"))
        .join(quality, "key")
        .groupBy("bin")
        .agg(F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"), F.count("*").alias("n"))
        .toPandas()
        .sort_values("bin", ascending=False)
    )
    good, bad = int(bins["good"].sum()), int((bins["n"] - bins["good"]).sum())
    if not good or not bad:
        return math.inf
    lost = 0
    for number, in_bin in zip(bins["bin"], bins["good"], strict=True):
        lost += int(in_bin)
        if lost > max_loss * good:
            return float(number) / SCORE_BINS
    return 0.0


def judge(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", passed: Sequence[str] = (), max_loss: float = MAX_LOSS
) -> DataFrame:
    """``kept`` (struct of key and passed columns), ``COUNTS``, ``score``, ``base_failed`` and ``keep``.

    ``keep`` is false if the fixed rules fail or the score exceeds the calibrated threshold. A
    null or empty text fails the rules. Copies get the same verdict; null keys match no label;
    an empty table gives no rows; tables too small for a forest score alike and are kept.
    """
    statistics = rule_statistics(df, text, list(dict.fromkeys([key, *passed])))
    forest = grow_forest(statistics.filter(~base_failed()))
    slim = statistics.select(F.struct(F.col("kept").getField(key).alias(key)).alias("kept"), *COUNTS)
    threshold = calibrated_threshold(scored(slim, forest), labels, key, max_loss)
    failed = F.col("base_failed")
    rated = scored(statistics, forest).withColumn("base_failed", base_failed())
    return rated.withColumn("keep", ~failed & (F.col("score") <= F.lit(threshold)))
