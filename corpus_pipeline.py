"""A pipeline for training text: toxic documents go, repeated lines go, near copies go, leaks go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet into the shared folder and read
again for the next. All stages but the last return the columns of ``docs``. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, lines, packing, toxicity
from tidemark.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.clean(docs, _table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of like lines, one stays; documents of repeated lines alone go."""
    return lines.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a Jaccard similarity of 0.8, one document stays."""
    return jaccard.one_of_each(docs, size=5, near=(80, 100))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which ten consecutive words of a benchmark item stand go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token pieces in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: No SQL: the learned scores, edit distances and tokens have none. tests/llm holds it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
