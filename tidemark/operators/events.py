"""Event-level joins and shaping: labels, dimensions, batches, sort order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import require
from tidemark.functions.times import epoch_seconds, parse_ts


def normalize(tx: DataFrame, ts: str = "ts") -> DataFrame:
    """Text times to timestamps (unreadable ones to NULL) and the epoch second next to them."""
    require(tx, [ts], "events")
    if dict(tx.dtypes)[ts] == "string":
        tx = tx.withColumn(ts, parse_ts(F.col(ts)))
    return tx.withColumn(f"{ts}_epoch", epoch_seconds(F.col(ts)))


def attach_labels(
    tx: DataFrame, labels: DataFrame, key: str = "t_id", name: str = "label_is_fraud"
) -> DataFrame:
    """1 where the event is labelled, else 0. A repeated label does not repeat the event, and nothing
    else of the label table is let through."""
    require(labels, [key], "labels")
    marked = labels.select(key).distinct().withColumn(name, F.lit(1))
    return tx.join(marked, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))


def enrich(tx: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Left-join dimension columns (``dimension column -> output name``) by a like-named unique key.

    No broadcast hint: Spark broadcasts the dimension below its size threshold and otherwise shuffles,
    where adaptive execution splits hot keys on the event side.
    """
    require(dimension, [key, *columns], "dimension")
    return tx.join(dimension.select(key, *(F.col(c).alias(n) for c, n in columns.items())), key, "left")


def stack(batches: Sequence[DataFrame]) -> DataFrame:
    """Concatenate landed batches; a column some batch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def sorted_by_time(df: DataFrame, ts: str, order_id: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The log in global time order: sampled range partitions, each sorted. The id is part of the range
    key, so a crowded instant still splits."""
    by = [ts, *order_id]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def order_inversions(written: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row that proves the order of a written table: n_rows, n_files, and inversions, the rows or files that begin before
    the one in front of them ends. Files are taken by name, rows by their place in the file.

    Rows are compared within their file, one file per task; files by their smallest and largest row alone.
    """
    key = F.struct(*by)
    rows = written.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key"))
    earlier = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("before", earlier).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("key") < F.col("before")).alias("inside"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # As many rows as files.
    between = F.col("low") < F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    counted = files.withColumn("between", F.coalesce(between, F.lit(False)))
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("inside") + F.count_if("between"), F.lit(0)).alias("inversions"),
    )


def drop_unlabelled(df: DataFrame, label: str = "label_is_fraud") -> DataFrame:
    return require(df, [label]).dropna(subset=[label])


def run_id_of(path: Column) -> Column:
    """The ``run_id=...`` segment of a path, ``unknown_run`` when there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"run_id=([^/]+)", 1), F.lit("")), F.lit("unknown_run"))


def in_bounds(column: Column, low: float, high: float) -> Column:
    """Range check that is False, not NULL, for a missing value."""
    return F.coalesce(column.between(low, high), F.lit(False))
