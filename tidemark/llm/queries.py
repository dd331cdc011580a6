"""Registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import codes, decontaminate, embeddings, jaccard, licenses, lines, mixing, oracles, packing, search, secrets, toxicity, warc, wrappers

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(_table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_table(spark, sf_dir, "documents")).report()


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_secret_scan": op2_secret_scan,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_html_text": op6_html_text,
    "op7_decontaminate": op7_decontaminate,
    "op8_license_scan": op8_license_scan,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_lexical_search": op12_lexical_search,
    "op13_source_mix": op13_source_mix,
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = dict(oracles.SQL)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
