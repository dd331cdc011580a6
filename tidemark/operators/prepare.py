"""Model-dependent preparation: split, imputation, scaling, encoding, class weights.

Everything learned is one row (or one short table) of statistics; applying it is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, require
from tidemark.operators.ordered import DEFAULT_TILES, TilePolicy, order_statistics


def row_hash(row_id: str, seed: int) -> Column:
    """60 bits of md5 over seed and id: the same in every run, engine and partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def hash_split(df: DataFrame, row_id: str, test_percent: float = 20, seed: int = 42, fine: bool = False) -> DataFrame:
    """Add ``is_test``: about ``test_percent`` of the rows, decided row by row (no exchange).

    Whole percents by the last digits of the hash; ``fine`` shares by the whole hash.
    """
    if fine:
        return df.withColumn("is_test", row_hash(row_id, seed) < F.lit(int(test_percent / 100 * 2**60)))
    return df.withColumn("is_test", (F.pmod(row_hash(row_id, seed), F.lit(100)) < test_percent))


def _smallest(hashed: DataFrame, label: str, counts: DataFrame, policy: TilePolicy) -> DataFrame:
    """Add ``__cut``: of each class, the ``k``-th smallest ``__hash`` (``counts``: class, k); NULL where k is 0."""
    wanted = counts.filter("k > 0").select(label, (F.col("k") - 1).cast("bigint").alias("rank"))
    cuts = order_statistics(hashed.select(label, F.col("__hash").alias("v")), wanted, [label], policy)
    cuts = cuts.select(F.col(label).alias("__class"), F.col("v").alias("__cut"))
    return hashed.join(cuts, F.col(label).eqNullSafe(F.col("__class")), "left").drop("__class")


def stratified_split(
    df: DataFrame,
    row_id: str,
    label: str,
    test_share: float = 0.2,
    seed: int = 42,
    policy: TilePolicy = DEFAULT_TILES,
) -> DataFrame:
    """Add ``is_test``: in each class, the ``round(share * n)`` rows of smallest hash.

    The cut hashes of all classes, of any number, are found together as order statistics; no class is sorted in one task.
    """
    hashed = df.withColumn("__hash", row_hash(row_id, seed))
    sizes = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(test_share) + 0.5).alias("k"))
    is_test = F.coalesce(F.col("__hash") <= F.col("__cut"), F.lit(False))
    return _smallest(hashed, label, sizes, policy).withColumn("is_test", is_test).drop("__hash", "__cut")


def bounded(df: DataFrame, row_id: str, label: str, most: int, seed: int, policy: TilePolicy = DEFAULT_TILES) -> DataFrame:
    """About ``most`` rows: of each class its share, and at least one, those of smallest hash."""
    total = df.count()
    if total <= most:
        return df
    hashed = df.withColumn("__hash", row_hash(row_id, seed))
    share = F.floor(F.count(F.lit(1)).cast("decimal(20,0)") * F.lit(most) / F.lit(total))
    sizes = df.groupBy(label).agg(F.greatest(F.lit(1), share).alias("k"))
    return _smallest(hashed, label, sizes, policy).filter("__hash <= __cut").drop("__hash", "__cut")


def class_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), policy: TilePolicy = DEFAULT_TILES) -> DataFrame:
    """(by, column, median): exact medians of all columns and classes at once, the mean of the two middle values when
    their number is even. The columns are counted side by side; see :func:`order_statistics` for the passes."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns))
    values = df.select(*by, F.inline(pairs)).filter(F.col("v").isNotNull())
    group = [*by, "column"]
    middle = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    ranks = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)))
    found = order_statistics(values, middle.select(*group, F.explode(ranks).alias("rank")), group, policy)
    return found.groupBy(*group).agg((F.min("v") + (F.max("v") - F.min("v")) * 0.5).alias("median"))


def medians(df: DataFrame, columns: Sequence[str], policy: TilePolicy = DEFAULT_TILES) -> dict[str, float | None]:
    """Exact median per column, NULL for a column without values."""
    if not columns:
        return {}
    found = {r["column"]: r["median"] for r in class_medians(df, columns, policy=policy).collect()}
    return {c: found.get(c) for c in columns}


def impute_median(df: DataFrame, columns: Sequence[str], policy: TilePolicy = DEFAULT_TILES) -> DataFrame:
    found = medians(df, columns, policy)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(found[c])) for c in columns})


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """The most frequent value per column, the smallest one on a tie."""
    out = {}
    for c in columns:
        counted = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        top = counted.orderBy(F.col("n").desc(), F.col(c)).limit(1).collect()
        out[c] = top[0][c] if top else None
    return out


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = most_frequent(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c])) for c in columns if found[c] is not None})


def population_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``mean_<c>`` and ``std_<c>`` (population) per column."""
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        parts += [F.avg(x).alias(f"mean_{c}"), F.stddev_pop(x).alias(f"std_{c}")]
    return df.agg(*parts)


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add ``(x - mean) / std`` per column, std over the population; a constant column becomes 0."""
    m = population_moments(df, columns).first()

    def scaled(c: str) -> Column:
        mean, std = m[f"mean_{c}"], m[f"std_{c}"]
        return (F.col(c).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def one_hot(df: DataFrame, column: str, vocabulary: Sequence[object]) -> DataFrame:
    """Add ``<column>_<value>`` 0/1 columns; a value outside the vocabulary has zeros in all of them."""
    hot = {f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in vocabulary}
    return df.withColumns(hot)


def category_hash(column: str, value: Column) -> Column:
    """60 bits of md5 of column name and value: the same in every run and engine, so nothing is learned or looked up."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{column}="), value.cast("string"))), 1, 15), 16, 10).cast("long")


def hashed_features(df: DataFrame, row_id: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(row id, bucket, value): signed feature hashing of any number of categories into ``buckets`` columns, zeros left out.

    Each value of each column adds 1 or -1, by the lowest bit of its hash, to the bucket of the other bits; values that meet
    in a bucket cancel on average instead of adding up. A NULL adds nothing. No vocabulary is built, so the width of a column costs
    nothing; the sums of a row are made within the row, without an exchange.
    """
    require(df, [*row_id, *columns], "hashed features")
    if buckets < 1:
        raise ContractError("feature hashing needs at least one bucket")

    def entry(c: str) -> Column:
        h = category_hash(c, F.col(c))
        sign = F.when(h.bitwiseAND(F.lit(1)) == 0, 1).otherwise(-1)
        bucket = F.pmod(F.shiftright(h, 1), F.lit(buckets))
        return F.when(F.col(c).isNotNull(), F.struct(bucket.cast("int").alias("bucket"), sign.alias("value")))

    entries = F.array_compact(F.array(*(entry(c) for c in columns)))

    def total(bucket: Column) -> Column:
        own = F.filter("__entries", lambda e: e["bucket"] == bucket)
        return F.struct(bucket.alias("bucket"), F.aggregate(own, F.lit(0), lambda t, e: t + e["value"]).alias("value"))

    sums = F.transform(F.array_distinct(F.col("__entries.bucket")), total)
    listed = df.select(*row_id, entries.alias("__entries")).select(*row_id, F.inline(sums))
    return listed.filter("value <> 0")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class: joined back to their own total, not windowed over the events.
    total = sizes.agg(F.sum("n").alias("__rows"), F.count(F.lit(1)).alias("__classes"))
    both = sizes.withColumn("__one", F.lit(1)).join(total.withColumn("__one", F.lit(1)), "__one")
    weight = F.col("__rows").cast("double") / (F.col("__classes") * F.col("n"))
    return both.select(label, "n", weight.alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col(label).alias("__class"), F.col("weight").alias(name))
    return df.join(weights, F.col(label) == F.col("__class"), "left").drop("__class")
