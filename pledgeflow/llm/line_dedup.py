"""Line deduplication over levelled sorted runs of line hashes, in DataFrame operations only.

A document becomes the hashes of its lines. Batches of documents, largest ids first, are
counted per hash; each batch is anti-joined with the runs written so far, so that a key's
keeper is set by the batch that brings it first, and adds a sorted run of its own. When a
level holds ``fan_out`` runs they are merged into one run of the next level.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.session import broadcast_if_small, materialise, work_path

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# stands for a null id, which sorts before all others
LEAST = -(1 << 63)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; pure ASCII texts take the faster built-in way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """MD5 of each line's key, null where the key is shorter than ``min_chars`` code points."""
    keys = F.transform(text_lines(text), lambda line: F.trim(line, F.lit(SPACE)))
    long_keys = F.transform(keys, lambda key: F.when(F.char_length(key) >= min_chars, lower_ascii(key)))
    return F.transform(long_keys, lambda key: F.md5(key.cast("binary")))


@dataclass
class LineRuns:
    """Runs of (key, n, keeper), sorted by key, on levels below one shared folder.

    ``n`` counts documents: distinct ids, and every row without an id; ``keeper`` is the largest id holding the key. A key has a keeper
    in one run only; later batches add their counts with a null keeper.
    """

    spark: SparkSession
    fan_out: int = 4
    levels: list[list[str]] = field(default_factory=list)

    def add(self, batch: DataFrame) -> None:
        """Add one batch of (id, again, keys); its ids must not exceed those of earlier batches.

        Rows whose id comes more than once (``again``) are one document: their keys count once.
        """
        found = batch.select("id", "again", F.explode(F.array_distinct("keys")).alias("key")).filter("key is not null")
        counted = found.filter("not again").unionByName(found.filter("again").distinct())
        counted = counted.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        seen = self._union(held_only=True)
        if seen is None:
            run = counted
        else:
            fresh = counted.join(seen, "key", "left_anti")
            known = counted.join(seen, "key", "left_semi").withColumn("keeper", F.lit(None).cast("long"))
            run = fresh.unionByName(known)
        self._write(run, 0)
        self._compact()

    def totals(self) -> DataFrame | None:
        """All runs merged: one row per key."""
        rows = self._union()
        return None if rows is None else self._merged(rows)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema("key string, n long, keeper long").parquet(path)

    def _union(self, held_only: bool = False) -> DataFrame | None:
        runs = [self._read(path) for level in self.levels for path in level]
        if held_only:
            runs = [run.filter("keeper is not null").select("key") for run in runs]
        return reduce(DataFrame.unionByName, runs) if runs else None

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def _write(self, run: DataFrame, level: int) -> None:
        path = work_path(self.spark, f"run-{level}")
        run.select("key", "n", "keeper").sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            paths = self.levels[level]
            if len(paths) >= self.fan_out:
                merged = self._merged(reduce(DataFrame.unionByName, map(self._read, paths)))
                self.levels[level] = []
                self._write(merged, level + 1)
            level += 1


def dropped_lines(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 6,
    fan_out: int = 4,
) -> DataFrame:
    """Positions of repeated lines: (id, digest, places), one row per document that loses lines.

    ``digest`` hashes the text, so that rows sharing an id stay apart.
    """
    spark = df.sparkSession
    bounds = df.select(F.percentile_approx(key, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    ident = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    batch = F.lit(0)
    for bound in sorted(set(bounds)):
        batch = batch + (ident <= bound).cast("int")
    hashed = df.select(
        ident.alias("id"),
        F.xxhash64(text).alias("digest"),
        line_hashes(F.col(text), min_chars).alias("keys"),
        batch.alias("batch"),
    ).filter(F.exists("keys", F.isnotnull))
    # rows that share an id are one document; they are told apart from all others before lines are counted
    again = df.filter(F.col(key).isNotNull()).groupBy(ident.alias("id")).agg(F.count("*").alias("n")).filter("n > 1")
    again = broadcast_if_small(again.select("id", F.lit(True).alias("again")))
    hashed = hashed.join(again, "id", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    path = work_path(spark, "lines")
    hashed.write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema(hashed.schema).parquet(path)
    runs = LineRuns(spark, fan_out)
    for number in range(len(set(bounds)) + 1):
        runs.add(hashed.filter(F.col("batch") == number))
    repeated = broadcast_if_small(runs.totals().filter(F.col("n") >= min_docs).select("key", "keeper"))
    places = hashed.select("id", "digest", F.posexplode("keys").alias("place", "key")).filter("key is not null")
    return (
        places.join(repeated, "key")
        .filter(F.col("id") != F.col("keeper"))
        .groupBy("id", "digest")
        .agg(F.collect_set("place").alias("places"))
    )


def dedup_lines(df: DataFrame, text: str = "text", key: str = "doc_id", **settings: int) -> DataFrame:
    """Drop lines repeated across documents, except in the largest id that holds them.

    Returns ``record`` (a struct of all columns of ``df``), ``kept`` (the text that is left),
    ``n_lines`` and ``n_dropped``. A line's key is the line stripped of ASCII white space, A-Z
    lowered; keys of at least ``min_chars`` code points found in ``min_docs`` or more documents
    count as repeated. Rows that share an id are one document, a row without one is its own; rows
    with the keeper's id all keep the line.

    A null or empty text is one empty line and stays empty; a null id sorts before all others;
    an empty table gives no rows; names cannot clash because the record stays a struct.
    """
    drops = materialise(dropped_lines(df, text, key, **settings))
    rows = df.select(
        F.struct("*").alias("record"),
        F.coalesce(F.col(key).cast("long"), F.lit(LEAST)).alias("id"),
        F.xxhash64(text).alias("digest"),
    )
    whole = F.col("record").getField(text)
    lines = text_lines(whole)
    n_lines = F.size("lines").cast("long")
    breaks = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    # one plan for every size: both sides are sorted by shuffle even where the drops are few
    return (
        rows.join(drops.hint("merge"), ["id", "digest"], "left")
        .select("record", "places", F.when(F.col("places").isNotNull(), lines).alias("lines"))
        .select(
            "record",
            F.when(F.col("places").isNull(), F.coalesce(whole, F.lit(""))).otherwise(kept).alias("kept"),
            F.when(F.col("places").isNull(), breaks + 1).otherwise(n_lines).alias("n_lines"),
            F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
        )
        .withColumn("n_lines", F.coalesce("n_lines", F.lit(1)).cast("long"))
    )
