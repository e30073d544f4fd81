"""Exact token-length histogram and what follows from its suffix sums.

Documents are encoded once and counted by length; totals, quantiles and truncated totals of
every context limit then come from the histogram alone.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import map_texts
from pledgeflow.session import materialise

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# lengths of one window task; sums over blocks of lengths give each block its start
BLOCK = 4096


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",), ranks: str = RANKS) -> DataFrame:
    """``kept`` (struct of passed columns) and ``n_tokens`` of each whole text; null and empty texts have none.

    ``ranks`` is a rank file that every executor can open.
    """

    def count(raw: bytes) -> list[tuple[int]]:
        return [(len(_encoding(ranks).encode_ordinary(raw.decode())),)]

    return map_texts(df, text, passed, [("n_tokens", T.LongType(), pa.int64())], count)


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per length with exact prefix and suffix sums.

    ``docs`` of this length; ``docs_within`` and ``tokens_within`` of at most this length;
    ``docs_beyond`` and ``tokens_beyond`` of more; ``truncated_tokens`` when every document is
    cut at this length; ``quantile`` = the share of documents of at most this length. Sums run
    in two levels, so no task sorts all lengths. No rows for an empty table.
    """
    counts = materialise(lengths.groupBy(F.col(length).alias("n_tokens")).agg(F.count("*").alias("docs")))
    block = F.floor(F.col("n_tokens") / BLOCK)
    counts = counts.withColumns({"block": block, "tokens": F.col("docs") * F.col("n_tokens")})
    sums = counts.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    before, everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    starts = sums.select(
        "block",
        F.coalesce(F.sum("block_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("block_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = counts.join(starts, "block").withColumns(
        {
            "docs_within": F.col("docs_before") + F.sum("docs").over(inside),
            "tokens_within": F.col("tokens_before") + F.sum("tokens").over(inside),
        }
    )
    beyond = F.col("all_docs") - F.col("docs_within")
    return within.select(
        "n_tokens",
        "docs",
        "docs_within",
        "tokens_within",
        beyond.alias("docs_beyond"),
        (F.col("all_tokens") - F.col("tokens_within")).alias("tokens_beyond"),
        (F.col("tokens_within") + beyond * F.col("n_tokens")).alias("truncated_tokens"),
        (F.col("docs_within") / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Per context limit: documents and tokens kept whole, documents cut, tokens after the cut."""
    limit = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    fits = F.col("n_tokens") <= F.col("limit")
    rows = histogram.select("n_tokens", "docs", limit.alias("limit"))
    return rows.groupBy("limit").agg(
        F.sum(F.when(fits, F.col("docs")).otherwise(0)).alias("whole_docs"),
        F.sum(F.when(fits, 0).otherwise(F.col("docs"))).alias("cut_docs"),
        F.sum(F.col("docs") * F.least("n_tokens", "limit")).alias("tokens"),
    )


def length_quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Smallest length that covers each share of documents."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    rows = histogram.select("n_tokens", "quantile", share.alias("share"))
    return rows.filter(F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
