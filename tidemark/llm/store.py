"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import shared_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The lineage ends at the files, which every executor can reach, so a lost executor costs the
    rereading of files and not the work before them. The size of the files is also what lets Spark
    choose a broadcast by a checked size.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
