"""Page-fetch logs: one row per fetched url with its response chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.operators.ordering import fold_runs, previous_value
from pledgeflow.session import materialise

_ORDER = ["block", "line_id"]
# lines of a block that are folded together
_STRETCH = 100_000


def fetch_log(lines: DataFrame) -> DataFrame:
    """Fold log lines (file, block, line_id, line) into (file, run, url, fetched_at, chain).

    A ``--time--  url`` line opens a fetch, unless it follows a redirect, in which case it
    continues the chain. Responses, redirect targets and an exceeded redirect limit are
    the pieces of the chain.
    """
    line = F.col("line")
    kind = (
        F.when(F.contains(line, F.lit("redirections exceeded")), "exceeded")
        .when(line.endswith("[following]"), "follow")
        .when(line.startswith("--"), "open")
        .when(F.contains(line, F.lit("response... ")), "response")
    )
    words = F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")
    piece = (
        F.when(F.col("kind") == "exceeded", "Redirections Exceeded")
        .when(F.col("kind") == "follow", F.get(words, F.lit(1)))
        .when(F.col("kind") == "response", F.substring_index(line, "response... ", -1))
    )
    opens = F.col("kind") == "open"
    marked = lines.withColumn("kind", kind).filter("kind is not null")
    # written once, so that line ids stay as they are; lines of a block come in the order of their ids
    steps = materialise(
        marked.select(
            "file",
            *_ORDER,
            F.floor(F.col("line_id") / _STRETCH).alias("stretch"),
            "kind",
            F.when(F.col("kind") != "response", F.col("kind")).alias("step"),
            piece.alias("piece"),
            F.when(opens, F.element_at(words, -1)).alias("url"),
            F.when(opens, F.replace(F.array_join(F.slice(words, 1, 2), " "), F.lit("--"), F.lit(""))).alias("fetched_at"),
        )
    )
    parts = ["block", "stretch"]
    rows = previous_value(steps, "step", _ORDER, ["file"], "before", parts)
    return fold_runs(
        rows,
        "file",
        _ORDER,
        opens & ~F.col("before").eqNullSafe("follow"),
        F.col("piece"),
        keep=["url", "fetched_at"],
        parts=parts,
    ).drop("started")


def brief_log(lines: DataFrame) -> DataFrame:
    """The short log form: url, output file and error code, one line per event.

    ``URL:`` lines report a stored page, `` ERROR `` lines the error of the url named on
    the line before.
    """
    line = F.col("line")
    words = F.split(line, " ")
    stored = F.contains(line, F.lit("URL:")) & F.contains(line, F.lit("->"))
    failed = F.contains(line, F.lit(" ERROR "))
    named = line.startswith("http") & line.endswith(":")
    marked = lines.withColumn(
        "kind", F.when(failed, "failed").when(stored, "stored").when(named, "named")
    ).filter("kind is not null")
    names = marked.withColumn("name", F.when(F.col("kind") == "named", line))
    carried = previous_value(names, "name", _ORDER, ["file"], "before")
    rows = carried.filter("kind <> 'named'")
    return rows.select(
        "file",
        F.when(F.col("kind") == "stored", F.replace(F.get(words, F.lit(2)), F.lit("URL:"), F.lit("")))
        .otherwise(F.rtrim(F.col("before"), F.lit(":")))
        .alias("url"),
        F.when(F.col("kind") == "stored", F.btrim(F.get(words, F.lit(5)), F.lit('"'))).alias("output_file"),
        F.when(F.col("kind") == "failed", F.rtrim(F.get(words, F.lit(3)), F.lit(":")).try_cast("int")).alias(
            "error_code"
        ),
        F.array_join(F.slice(words, 1, 2), " ").alias("fetched_at"),
    )
