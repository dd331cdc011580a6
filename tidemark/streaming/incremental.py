"""Ingest and materialization of whatever has newly landed, as Structured Streaming queries.

Both use the batch operators and ``trigger(availableNow=True)``: the checkpoint knows which files are done.
An ingested micro-batch goes to a folder named after its id, so that a batch repeated after a failure
overwrites itself; a materialized one makes the next version of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.entities import FeatureView, latest
from tidemark.sources.jsonl import parse_lines, typed
from tidemark.sources.paths import hadoop_uri


def ingest_available(
    spark: SparkSession, landing: str, schema: T.StructType, target: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """Landed JSON-lines files not seen before -> Parquet below ``target``, broken lines below ``rejects``."""
    lines = spark.readStream.text(hadoop_uri(landing)).select("value", "_metadata")

    def write(batch: DataFrame, batch_id: int) -> None:
        landed = parse_lines(batch, schema)
        for part, path in ((typed(landed.rows), target), (landed.rejects, rejects)):
            part.write.mode("overwrite").parquet(f"{hadoop_uri(path)}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", hadoop_uri(checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def materialize_available(source: DataFrame, view: FeatureView, online: str, checkpoint: str) -> StreamingQuery:
    """Move an online table forward by the new rows of a feature stream; each batch is a new version.

    Versions count on from the newest one in the folder, not from the batch id, which starts anew with a new
    checkpoint. A batch that is repeated after a failure adds the same rows again, which changes nothing.
    """
    spark, root = source.sparkSession, hadoop_uri(online)

    def write(batch: DataFrame, batch_id: int) -> None:
        new, newest = latest(view.project(batch), view.keys, view.ts), newest_version(spark, online)
        if newest is not None:
            new = latest(spark.read.parquet(f"{root}/version={newest}").unionByName(new), view.keys, view.ts)
        new.write.parquet(f"{root}/version={0 if newest is None else newest + 1}")

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", hadoop_uri(checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def dedupe_available(source: DataFrame, keys: Sequence[str], ts: str, delay: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append each event of a stream once to Parquet below ``target``.

    The state store remembers the keys of events until the watermark, ``delay`` behind the newest event time, has passed them:
    a copy whose time is within ``delay`` of the first one is dropped, also after a restart. The state is as large as the keys of
    that span, whatever the length of the stream. Rows without a time have no place in it and are left out.
    """
    return (
        source.filter(F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .writeStream.format("parquet")
        .option("path", hadoop_uri(target))
        .option("checkpointLocation", hadoop_uri(checkpoint))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def newest_version(spark: SparkSession, online: str) -> int | None:
    """The number of the newest version of a table kept by :func:`materialize_available`."""
    try:
        versions = spark.read.parquet(hadoop_uri(online))
    except AnalysisException:
        return None
    return versions.agg(F.max("version")).first()[0]


def online_version(spark: SparkSession, online: str) -> DataFrame:
    """The newest version of a table kept by :func:`materialize_available`."""
    newest = newest_version(spark, online)
    return spark.read.parquet(f"{hadoop_uri(online)}/version={newest}")
