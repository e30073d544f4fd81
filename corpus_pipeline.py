"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, best-fit packing.

Each stage takes (spark, documents, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.llm import line_dedup, packing, quality, simhash
from pledgeflow.session import scratch, work_path

# counting and whole-text stages have no SQL form: tests compare them with brute force
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the isolation forest, unchanged."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.judge(docs, labels, passed=docs.columns).filter("keep").select("kept.*").select(docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they repeat; ``n_chars`` follows where a text has changed."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    values = {
        "text": F.when(changed, F.col("kept")).otherwise(F.col("record.text")),
        "n_chars": F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("record.n_chars")),
    }
    return kept.select(*[values.get(c, F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def simhash_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group whose fingerprints of four-word shingles link at four bits or fewer."""
    return simhash.representatives(docs, words=4, radius=4).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences."""
    placed = packing.pack_documents(docs)
    return placed.select("kept.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", simhash_deduplication),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written below the shared folder.

    What a stage wrote for itself is removed when it ends, its result when the next stage has read it.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    path, schema = None, None
    for i, (name, stage) in enumerate(STAGES):
        target = work_path(spark, f"stage-{i}")
        with scratch(spark, *([path] if path else [])):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(target)
            path, schema = target, out.schema
        docs = spark.read.schema(schema).parquet(path)
    return docs
