"""Exact statistics over one globally sorted column: running totals, quantiles, order statistics.

A window over the whole table would sort it in one task. Here the column is first reduced to one row
per distinct value, then cut at approximate quantiles into tiles of about ``tile_rows`` values; windows
run per tile, and the totals of the tiles before are added. The cut points are plain numbers fixed
before the plan is built: they only decide which task works on what, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_dir

_TILE = "__value_tile"
_BINS = 4096
_DEEP = 200_000  # accuracy of the approximate quantiles: rank error below rows / _DEEP


@dataclass(frozen=True)
class TilePolicy:
    tile_rows: int = 1_000_000
    max_tiles: int = 10_000  # bounds the cut points, and the tile totals that are broadcast


DEFAULT_TILES = TilePolicy()


def frequencies(df: DataFrame, value: Column, **sums: Column) -> DataFrame:
    """One row per distinct non-NULL value: ``v``, its row count ``n``, and the asked-for sums."""
    inputs = df.select(value.alias("v"), *(c.alias(name) for name, c in sums.items()))
    return (
        inputs.filter(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(name).alias(name) for name in sums))
    )


def totals_before(
    values: DataFrame, sums: Sequence[str], order: str = "v", policy: TilePolicy = DEFAULT_TILES
) -> DataFrame:
    """Add ``<sum>_before``: the total over all smaller values. ``values`` has one row per value."""
    tiled, n_tiles = _tile(values, order, policy)
    earlier = Window.partitionBy(_TILE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = tiled.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums})
    if n_tiles > 1:
        tiles = tiled.groupBy(_TILE).agg(*(F.sum(c).alias(c) for c in sums))
        # At most max_tiles rows: a single-task window and a broadcast are fine.
        before = Window.orderBy(_TILE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = tiles.select(
            _TILE, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__off_{c}") for c in sums)
        )
        out = out.join(F.broadcast(offsets), _TILE).withColumns(
            {f"{c}_before": F.col(f"{c}_before") + F.col(f"__off_{c}") for c in sums}
        )
    return out.select(*values.columns, *(f"{c}_before" for c in sums))


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], policy: TilePolicy = DEFAULT_TILES
) -> DataFrame:
    """One row with an exact, linearly interpolated quantile per output name (NULLs are left out)."""
    freq = frequencies(df, F.col(value))
    n = freq.agg(F.sum("n")).first()[0] or 0
    ranks = {name: p * (n - 1) for name, p in probabilities.items()}
    wanted = sorted({r for pos in ranks.values() for r in (math.floor(pos), math.ceil(pos))})
    picks = _pick_ranks(freq, wanted, policy)
    outputs = []
    for name, pos in ranks.items():
        low, high = F.col(f"r{math.floor(pos)}"), F.col(f"r{math.ceil(pos)}")
        share = pos - math.floor(pos)
        outputs.append((low if not share else low + (high - low) * share).alias(name))
    return picks.select(*outputs)


def kth_smallest(df: DataFrame, value: Column, k: int, policy: TilePolicy = DEFAULT_TILES) -> float | None:
    """The k-th smallest value (1-based), or None when there are fewer."""
    if k < 1:
        return None
    return _pick_ranks(frequencies(df, value), [k - 1], policy, as_double=False).first()[0]


def order_statistics(values: DataFrame, wanted: DataFrame, by: Sequence[str], policy: TilePolicy = DEFAULT_TILES) -> DataFrame:
    """(by, rank, v): the values at the wanted ranks (0-based) of many groups at once, exactly.

    ``values`` has ``by`` and a number ``v``, not NULL; ``wanted`` has ``by`` and ``rank``. Every pass over the values counts,
    for each rank, the values between its bounds in up to 4096 bins, keeps the bin that holds the rank, and takes that bin's
    smallest and largest value as the next bounds, until they are equal. Bins are equal steps of the value, and in every second
    pass of its logarithm, so numbers of any spread part in a few passes. A pass sends at most so many rows per rank and
    task through its exchange; no column is sorted, and the number of passes does not depend on groups or columns. Ranks
    without such a value are left out.
    """
    spark, same = values.sparkSession, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    values = values.select(*by, "v")
    ends = values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    renamed = wanted.select(*(F.col(c).alias(f"__{c}") for c in by), "rank")
    state = ends.join(renamed, reduce(lambda a, b: a & b, same, F.lit(True)), "inner").filter("rank between 0 and n - 1")
    state = state.select(*(F.col(f"__{c}") for c in by), "rank", "lo", "hi", F.lit(0).cast("bigint").alias("below"))
    schema, done, logarithms = state.schema, [], False
    keyed = [f"__{c}" for c in by]
    bins = max(2, min(_BINS, policy.tile_rows))
    whole = isinstance(values.schema["v"].dataType, T.IntegralType)

    def step(a: Column, b: Column) -> Column:
        return (a.cast("decimal(20,0)") - b.cast("decimal(20,0)")).cast("double") if whole else a.cast("double") - b.cast("double")

    while True:
        # One row per wanted rank, written so that a pass does not hang on the passes before.
        path = shared_dir(spark, "ranks")
        state.write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        done.append(state.filter("lo = hi"))
        open_ = state.filter("lo < hi")
        if open_.isEmpty():
            return reduce(DataFrame.unionAll, done).select(*(F.col(f"__{c}").alias(c) for c in by), "rank", F.col("lo").alias("v"))
        met = values.join(open_, reduce(lambda a, b: a & b, same, F.lit(True))).filter(F.col("v").between(F.col("lo"), F.col("hi")))
        if logarithms:
            part, of = _signed_log(F.col("v")) - _signed_log(F.col("lo")), _signed_log(F.col("hi")) - _signed_log(F.col("lo"))
        else:
            part, of = step(F.col("v"), F.col("lo")), step(F.col("hi"), F.col("lo"))
        place = F.when(of > 0, F.least(F.floor(part / of * bins), F.lit(bins - 1)))
        # Bounds whose difference is too small or too large for a step: the two ends part at least.
        place = F.when(F.col("v") == F.col("lo"), -1).when(F.col("v") == F.col("hi"), bins).otherwise(F.coalesce(place, F.lit(0)))
        counted = met.groupBy(*keyed, "rank", "below", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = Window.partitionBy(*keyed, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("below", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        kept = placed.filter((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n")))
        state, logarithms = kept.select(*schema.names), not logarithms


def _signed_log(value: Column) -> Column:
    """Grows with the value, by orders of magnitude on both sides of 0 (the smallest double has a logarithm of -745)."""
    number = value.cast("double")
    return F.coalesce(F.signum(number) * (F.log(F.abs(number)) + F.lit(800.0)), F.lit(0.0))


def _pick_ranks(freq: DataFrame, ranks: Sequence[int], policy: TilePolicy, as_double: bool = True) -> DataFrame:
    placed = totals_before(freq, ["n"], policy=policy)
    value = F.col("v").cast("double") if as_double else F.col("v")

    def at(rank: int) -> Column:
        here = (F.col("n_before") <= rank) & (F.col("n_before") + F.col("n") > rank)
        return F.max(F.when(here, value)).alias(f"r{rank}")

    return placed.agg(*(at(r) for r in ranks))


def _tile(values: DataFrame, order: str, policy: TilePolicy) -> tuple[DataFrame, int]:
    number = F.col(order).cast("double")
    n = values.count()
    n_tiles = min(policy.max_tiles, math.ceil(n / policy.tile_rows))
    if n_tiles <= 1:
        return values.withColumn(_TILE, F.lit(0)), 1
    steps = [i / n_tiles for i in range(1, n_tiles)]
    cuts = values.agg(F.percentile_approx(number, steps, _DEEP)).first()[0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    cut = Bucketizer(splits=splits, inputCol="__number", outputCol=_TILE, handleInvalid="keep")
    return cut.transform(values.withColumn("__number", number)).drop("__number"), len(splits)
