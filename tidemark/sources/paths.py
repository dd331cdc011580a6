"""Path handling. Credentials, endpoints and file-system jars are the session's business."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def hadoop_uri(path: str) -> str:
    """``s3://`` becomes ``s3a://``, the scheme of Hadoop's connector; all else is left as it is."""
    return "s3a://" + path[len("s3://") :] if path.startswith("s3://") else path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file, directory or glob."""
    return spark.read.parquet(hadoop_uri(path))


def write_parquet(df: DataFrame, path: str) -> str:
    """Overwrite ``path``."""
    target = hadoop_uri(path)
    df.write.mode("overwrite").parquet(target)
    return target
