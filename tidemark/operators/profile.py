"""Profiling of a training set: every report is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import require
from tidemark.functions.scalars import percent


def shape(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Row count, column count and, with ``ts``, the time range."""
    times = [F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")] if ts else []
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"), *times)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def distinct_keys(df: DataFrame, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """``n_<key>`` distinct values per key column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*(count(k).alias(f"n_{k}") for k in keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, as one number."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = 20) -> DataFrame:
    """(column_name, n_null, n_rows, pct_null), most nulls first; ``top`` is the length of the report."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *((F.count(F.lit(1)) - F.count(c)).alias(f"__{i}") for i, c in enumerate(columns)),
    )
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"__{i}").alias("n_null")) for i, c in enumerate(columns))
    )
    long = counts.select("n_rows", F.inline(pairs)).select(
        "column_name", "n_null", "n_rows", percent(F.col("n_null"), F.col("n_rows")).alias("pct_null")
    )
    ordered = long.orderBy(F.col("n_null").desc(), "column_name")
    return ordered.limit(top) if top else ordered


def coverage(df: DataFrame, groups: dict[str, str]) -> DataFrame:
    """``n_rows`` and, for each ``name -> column``, how many rows have the column."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"{name}_covered") for name, c in groups.items())
    )


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"),
        F.avg(c.cast("double")).alias("mean"),
        F.stddev_samp(c.cast("double")).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    )


def approximate_percentiles(df: DataFrame, column: str, probabilities: dict[str, float], accuracy: int = 10_000):
    """One row of approximate percentiles; see :func:`tidemark.operators.ordered.quantiles` for exact ones."""
    return df.agg(*(F.percentile_approx(column, p, accuracy).alias(name) for name, p in probabilities.items()))


def sketches(
    df: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), numeric: Sequence[str] = (), lg_k: int = 12, k: int = 1600
) -> DataFrame:
    """One row per group with ``n_rows``, a distinct-count sketch per ``distinct`` column and a quantile sketch per ``numeric`` one.

    A sketch has a size bound of its own (about ``2^lg_k`` bytes; a few ``k`` numbers), whatever the group's size, and sketches of
    parts add up to the sketch of the whole: a day's row is stored once, and months are answered from their days.
    """
    require(df, [*by, *distinct, *numeric], "sketches")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.hll_sketch_agg(c, lg_k).alias(f"distinct_{c}") for c in distinct),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"ranks_{c}") for c in numeric),
    )


def merge_sketches(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The stored rows of :func:`sketches` put together per coarser group; the data are not read again."""
    merged = [F.hll_union_agg(c).alias(c) for c in stored.columns if c.startswith("distinct_") and c not in by]
    merged += [F.kll_merge_agg_double(c).alias(c) for c in stored.columns if c.startswith("ranks_") and c not in by]
    return stored.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *merged)


def distinct_estimate(column: str) -> Column:
    """Distinct values of a sketched column; with ``lg_k`` 12, within 5 % (three standard errors)."""
    return F.hll_sketch_estimate(f"distinct_{column}")


def quantile_estimate(column: str, p: float) -> Column:
    """A value of the sketched column whose rank is near ``p``; with ``k`` 1600, within 0.5 % of the rows."""
    return F.kll_sketch_get_quantile_double(F.col(f"ranks_{column}"), F.lit(float(p)))


def group_mean(df: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """Mean per group; by label, a feature that knows the label stands out."""
    return df.groupBy(group).agg(F.avg(F.col(column).cast("double")).alias(name)).orderBy(group)


def sample_per_group(df: DataFrame, group: str, order_id: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows per group in id order; cut to ``n`` per task before the exchange."""
    require(df, [group, *order_id])
    first = Window.partitionBy(group).orderBy(*order_id)
    return df.withColumn("__rank", F.row_number().over(first)).filter(F.col("__rank") <= n).drop("__rank")


def preview(df: DataFrame, order_id: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows and, on each, the number of records."""
    total = df.agg(F.count(F.lit(1)).alias("n_records")).withColumn("__one", F.lit(1))
    head = df.orderBy(*order_id).limit(n).withColumn("__one", F.lit(1))
    return head.join(total, "__one").drop("__one")
