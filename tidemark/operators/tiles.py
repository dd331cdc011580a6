"""Cutting heavy keys into time tiles.

A window partitioned by key puts all rows of one key into one task. That is the best plan as long as
every key fits into a task, and a dead end when one card or merchant owns a third of the table. So the
keyed operators first *measure*: one narrow aggregate lists the keys that need care. Without such keys
the plain one-shuffle window runs. With them, keys above ``tile_rows``, and only they, are cut into time
tiles of about that many *rows*, however unevenly these lie in time: the cut points are quantiles of the
key's seconds. The window is partitioned by (key, tile), and each tile is opened by one
*carry row* that sums up everything the key did before the tile. Rows of one second stay together.

Sizes: tiles number at most ``2 * rows / tile_rows`` plus one per heavy key, and the list of keys is cut at
``max_keys``, which bounds what is broadcast. Keys beyond the list are still computed in full, as plain
partitions; being outside the ``max_keys`` largest, each holds at most ``rows / max_keys`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import require

TILE = "__tile"
_START, _END, _CUTS = "__tile_start", "__key_end", "__tile_cuts"
HELPERS = (TILE, _START, _END)


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as dense or heavy."""

    frame_rows: int = 500  # rows within the longest frame's length above which re-adding frames costs more
    tile_rows: int = 100_000  # target rows per (key, tile)
    max_keys: int = 100_000  # longest list of keys held on the driver and broadcast
    split_share: float = 0.5  # up to this share of the rows, listed keys get a plan of their own


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class KeyLoad:
    """The keys that need care: columns = key columns, n, lo, hi (epoch seconds); largest first."""

    keys: tuple[str, ...]
    policy: SkewPolicy
    table: pa.Table
    total_rows: int
    cuts: pa.Table | None = None  # per heavy key: key columns, the first second of each tile, the last second

    @property
    def any_listed(self) -> bool:
        return self.table.num_rows > 0

    @property
    def splits(self) -> bool:
        """True when the list is complete and covers the smaller part of the rows."""
        listed = pc.sum(self.table["n"]).as_py() or 0
        complete = self.table.num_rows < self.policy.max_keys
        return complete and listed <= self.policy.split_share * self.total_rows

    @property
    def heavy(self) -> pa.Table:
        return self.table.filter(pc.greater(self.table["n"], self.policy.tile_rows))

    @property
    def tiled(self) -> bool:
        return self.heavy.num_rows > 0


def measure(
    df: DataFrame,
    keys: Sequence[str],
    seconds: Column,
    policy: SkewPolicy = DEFAULT_POLICY,
    reach: int | None = None,
) -> KeyLoad:
    """Count rows per key (partial aggregation over the key and time columns) and list the keys above
    ``tile_rows``; with ``reach``, also those with over ``frame_rows`` rows in any ``reach`` seconds' bucket.
    The heavy keys' cut points are measured as well."""
    require(df, keys)
    timed = df.select(*keys, seconds.alias("__s"))
    bucket = [] if reach is None else [F.floor(F.col("__s") / F.lit(reach + 1)).alias("__bucket")]
    counts = timed.groupBy(*keys, *bucket).agg(F.count(F.lit(1)).alias("n"), F.min("__s").alias("lo"), F.max("__s").alias("hi"))
    sizes = [F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max(F.when(F.col("lo").isNotNull(), F.col("n"))).alias("peak")]
    stats = counts.groupBy(*keys).agg(*sizes)
    listed = F.col("n") > policy.tile_rows
    if reach is not None:
        listed = listed | (F.col("peak") > policy.frame_rows)
    found = (
        stats.filter(listed & F.col("lo").isNotNull())
        .drop("peak")
        .orderBy(F.col("n").desc(), *keys)
        .limit(policy.max_keys)
        .withColumn("is_total", F.lit(False))
    )
    # The total reads the same columns as the list, so that both share one exchange.
    total = stats.agg(*(f(c).alias(c) for f, c in ((F.sum, "n"), (F.min, "lo"), (F.max, "hi"))))
    table = found.unionByName(total.withColumn("is_total", F.lit(True)), allowMissingColumns=True).toArrow()
    is_total = table["is_total"]
    total_rows = pc.sum(table.filter(is_total)["n"]).as_py() or 0
    load = KeyLoad(tuple(keys), policy, table.filter(pc.invert(is_total)).drop_columns("is_total"), total_rows)
    return replace(load, cuts=_cut_points(timed, load)) if load.tiled else load


def _cut_points(timed: DataFrame, load: KeyLoad) -> pa.Table:
    """Quantiles of the heavy keys' seconds. Keys of like size share a query, sizes going up by factors of two."""
    heavy = load.heavy
    tiles = [1 << max(0, -(-n // load.policy.tile_rows) - 1).bit_length() for n in heavy["n"].to_pylist()]
    keyed: dict[tuple, list[int]] = {}
    for count in sorted(set(tiles)):
        mine = heavy.filter(pa.array([t == count for t in tiles]))
        shares = [k / count for k in range(1, count)]
        if not shares:
            continue
        part = split_by_load(timed, replace(load, table=mine))[0]
        cuts = F.percentile_approx("__s", F.array(*map(F.lit, shares)), F.lit(max(10_000, 20 * count)))
        for row in part.groupBy(*load.keys).agg(cuts.alias("cuts")).collect():
            keyed[tuple(row[k] for k in load.keys)] = row["cuts"]
    columns: dict[str, list] = {f"__h_{k}": heavy[k] for k in load.keys}
    starts = []
    for row in heavy.to_pylist():
        starts.append(sorted({row["lo"], *(c + 1 for c in keyed.get(tuple(row[k] for k in load.keys), ()) if c < row["hi"])}))
    return pa.table({**columns, _CUTS: pa.array(starts, pa.list_(pa.int64())), _END: heavy["hi"]})


def split_by_load(df: DataFrame, load: KeyLoad) -> tuple[DataFrame, DataFrame]:
    """(rows of listed keys, all other rows)."""
    keys = pa.table({f"__h_{k}": load.table[k] for k in load.keys})
    listed = df.sparkSession.createDataFrame(keys)
    same_key = _same_key(df, listed, load)
    return df.join(F.broadcast(listed), same_key, "left_semi"), df.join(F.broadcast(listed), same_key, "left_anti")


def _same_key(df: DataFrame, listed: DataFrame, load: KeyLoad) -> Column:
    return reduce(lambda a, b: a & b, (df[k].eqNullSafe(listed[f"__h_{k}"]) for k in load.keys))


def add_tile(df: DataFrame, load: KeyLoad, seconds: Column) -> DataFrame:
    """Add the tile number: 0 for light keys, -1 for heavy keys without a time."""
    heavy = df.sparkSession.createDataFrame(load.cuts)
    joined = df.join(F.broadcast(heavy), _same_key(df, heavy, load), "left").drop(*(f"__h_{k}" for k in load.keys))
    # The number of cuts up to this second, by halving steps.
    most = max(len(c) for c in load.cuts[_CUTS].to_pylist())
    steps = F.array(*(F.lit(1 << k) for k in range(most.bit_length() - 1, -1, -1)))
    passed = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(F.col(_CUTS), at + step - 1) <= seconds, at + step).otherwise(at)
    )
    tile = F.when(F.col(_END).isNull(), F.lit(0)).otherwise(F.when(seconds.isNull(), F.lit(-1)).otherwise(F.greatest(passed - 1, F.lit(0))))
    placed = joined.withColumn(TILE, tile.cast("long"))
    start = F.when(F.col(TILE) >= 0, F.get(F.col(_CUTS), F.col(TILE).cast("int")))
    return placed.withColumn(_START, start).drop(_CUTS)


def is_heavy() -> Column:
    return F.col(_END).isNotNull()


def within_key_span(seconds: Column) -> Column:
    """False for derived rows that fall behind the last row of a heavy key."""
    return F.col(_END).isNull() | (seconds <= F.col(_END))


def tile_opening_second() -> Column:
    """A second before every row of the tile and after every row of the tiles before it, or equal to
    their last second; carry rows stand there."""
    return F.col(_START) - 1
