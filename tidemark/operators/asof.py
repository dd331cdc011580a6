"""Point-in-time joins: for each left row, the newest right row of its key that is not in its future."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, require
from tidemark.functions.times import epoch_seconds
from tidemark.operators.tiles import DEFAULT_POLICY, HELPERS, TILE, SkewPolicy, add_tile, is_heavy, measure

# Rows whose key or time is NULL match nothing; they are spread over this many partitions instead of one.
_NULL_KEY_SPREAD = 4096


def output_names(
    left: DataFrame, carried: Sequence[str], names: Mapping[str, str] | None, matched_ts: str | None
) -> dict[str, str]:
    """Right column -> output column: what ``names`` says, its own name otherwise.

    Refused are names for columns that the right side does not carry, and an output column that would stand there twice.
    """
    names = dict(names or {})
    unknown = sorted(set(names) - set(carried))
    if unknown:
        raise ContractError(f"names for columns {unknown}, which the right side does not carry; it carries {sorted(carried)}")
    out = {c: names.get(c, c) for c in carried}
    taken = Counter([*left.columns, *out.values(), *([matched_ts] if matched_ts else [])])
    repeated = sorted(c for c, n in taken.items() if n > 1)
    if repeated:
        raise ContractError(f"as-of join would repeat columns {repeated}; give them other names")
    return out


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_id: Sequence[str] = (),
    names: Mapping[str, str] | None = None,
    ttl_seconds: int | None = None,
    allow_exact: bool = True,
    matched_ts: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left rows, all of them and once each, with the columns of their newest earlier right row.

    ``names`` gives right columns other names in the output. ``allow_exact`` admits a right row of the same instant. Right rows of one instant are ordered by
    ``right_id`` and the largest wins. With ``ttl_seconds``, an older match counts as none.

    Both sides are stacked and sorted by time within the key, and the last right row seen is carried
    forward: one exchange, cost linear in the rows of both sides, no pairs. Heavy keys are cut into
    time tiles; a tile starts with the last right row before it.
    """
    require(left, [*left_keys, left_ts], "left side")
    require(right, [*right_keys, right_ts, *right_id], "right side")
    carried = [c for c in right.columns if c not in {*right_keys, right_ts}]
    out_names = output_names(left, carried, names, matched_ts)

    keys = [f"__k{i}" for i in range(len(left_keys))]
    ids = [f"__i{i}" for i in range(len(right_id))]
    hit = F.struct(F.col(right_ts).alias("__ts"), *carried)
    lefts = left.select(
        *(F.col(c).alias(k) for c, k in zip(left_keys, keys)),
        F.col(left_ts).alias("__t"),
        F.lit(1 if allow_exact else 0).alias("__side"),
        F.struct(*left.columns).alias("__row"),
    )
    rights = right.select(
        *(F.col(c).alias(k) for c, k in zip(right_keys, keys)),
        F.col(right_ts).alias("__t"),
        F.lit(0 if allow_exact else 1).alias("__side"),
        *(F.col(c).alias(i) for c, i in zip(right_id, ids)),
        hit.alias("__hit"),
    ).filter(_all_set([*keys, "__t"]))
    stacked = lefts.unionByName(rights, allowMissingColumns=True)

    times = epoch_seconds(F.col("__t"))
    narrow = lefts.select(*keys, "__t").unionAll(rights.select(*keys, "__t")).filter(_all_set([*keys, "__t"]))
    load = measure(narrow, keys, times, policy)
    # Rows without a key or a time match nothing and go round the keys' partitions, spread by all their plain columns.
    no_key = F.col("__row").isNotNull() & ~_all_set([*keys, "__t"])
    plain = [f"__row.{c}" for c, t in left.dtypes if not t.startswith(("map", "array", "struct"))]
    spread = -2 - F.pmod(F.xxhash64("__t", *plain), F.lit(_NULL_KEY_SPREAD))
    if load.tiled:
        stacked = add_tile(stacked, load, times)
        stacked = stacked.unionByName(_carry(stacked, keys, ids), allowMissingColumns=True)
        stacked = stacked.withColumn(TILE, F.when(no_key, spread).otherwise(F.col(TILE)))
    else:
        stacked = stacked.withColumn(TILE, F.when(no_key, spread).otherwise(F.lit(0)))

    so_far = (
        Window.partitionBy(*keys, TILE)
        .orderBy("__t", "__side", *ids)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = stacked.withColumn("__found", F.last("__hit", ignorenulls=True).over(so_far))
    found = found.filter(F.col("__row").isNotNull())
    if ttl_seconds is not None:
        oldest = F.col("__t") - F.make_dt_interval(secs=F.lit(ttl_seconds))
        found = found.withColumn("__found", F.when(F.col("__found.__ts") >= oldest, F.col("__found")))
    return found.select(
        "__row.*",
        *([F.col("__found.__ts").alias(matched_ts)] if matched_ts else []),
        *(F.col(f"__found.{c}").alias(out_names[c]) for c in carried),
    )


def asof_band(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    left_id: Sequence[str],
    ttl_seconds: int,
    right_id: Sequence[str] = (),
    names: Mapping[str, str] | None = None,
    allow_exact: bool = True,
    matched_ts: str | None = None,
) -> DataFrame:
    """:func:`asof_join` with a bounded age, as a join on time bands instead of a sorted pass.

    Time is cut into buckets as long as the age bound: a match lies in the left row's bucket or the one before. Right rows
    stand in their own bucket and the next, so the join is an equi-join on key and bucket, and a crowded key is spread over its
    buckets, which adaptive execution splits further. Of a left row's candidates one aggregate keeps the newest. This emits
    the pairs within two buckets: good for short ages and few right rows each, where the left side need not be sorted;
    :func:`asof_join` has no such bound. ``left_id`` is unique on the left side.
    """
    require(left, [*left_keys, left_ts, *left_id], "left side")
    require(right, [*right_keys, right_ts, *right_id], "right side")
    if ttl_seconds <= 0:
        raise ContractError("a band needs an age above 0")
    carried = [c for c in right.columns if c not in {*right_keys, right_ts}]
    out_names = output_names(left, carried, names, matched_ts)

    keys = [f"__k{i}" for i in range(len(left_keys))]
    bucket = lambda ts: F.floor(epoch_seconds(F.col(ts)) / F.lit(ttl_seconds))
    lefts = left.select(
        *(F.col(c).alias(k) for c, k in zip(left_keys, keys)),
        bucket(left_ts).alias("__b"),
        F.col(left_ts).alias("__t"),
        F.struct(*(F.col(c) for c in left_id)).alias("__id"),
    ).filter(_all_set([*keys, "__t"]))
    rights = right.select(
        *(F.col(c).alias(k) for c, k in zip(right_keys, keys)),
        F.explode(F.array(bucket(right_ts), bucket(right_ts) + 1)).alias("__b"),
        F.col(right_ts).alias("__ts"),
        F.struct(F.col(right_ts).alias("__ts"), *right_id).alias("__newest"),
        F.struct(F.col(right_ts).alias("__ts"), *carried).alias("__hit"),
    ).filter(_all_set([*keys, "__ts"]))
    age = F.make_dt_interval(secs=F.lit(ttl_seconds))
    within = (F.col("__ts") <= F.col("__t")) if allow_exact else (F.col("__ts") < F.col("__t"))
    pairs = lefts.join(rights, [*keys, "__b"]).filter(within & (F.col("__ts") >= F.col("__t") - age))
    best = pairs.groupBy("__id").agg(F.max_by("__hit", "__newest").alias("__found"))
    out = left.withColumn("__id", F.struct(*(F.col(c) for c in left_id))).join(best, "__id", "left")
    return out.select(
        *left.columns,
        *([F.col("__found.__ts").alias(matched_ts)] if matched_ts else []),
        *(F.col(f"__found.{c}").alias(out_names[c]) for c in carried),
    )


def best_per_left_id(
    joined: DataFrame, left_id: Sequence[str], matched_ts: str, order_id: Sequence[str] = ()
) -> DataFrame:
    """One row per left id, the one with the newest match, unmatched rows last."""
    newest = Window.partitionBy(*left_id).orderBy(
        F.col(matched_ts).desc_nulls_last(), *(F.col(c).desc() for c in order_id)
    )
    ranked = joined.withColumn("__rank", F.row_number().over(newest))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


@dataclass(frozen=True)
class FeatureTable:
    """One right side of a training set."""

    df: DataFrame
    keys: tuple[str, ...]
    ts: str
    names: Mapping[str, str] = field(default_factory=dict)
    id: tuple[str, ...] = ()
    ttl_seconds: int | None = None


def asof_join_all(
    base: DataFrame, tables: Sequence[FeatureTable], ts: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Join any number of feature tables, each keyed by like-named columns of ``base``."""
    for table in tables:
        # The id only breaks ties: it is packed under a name that cannot meet a base column.
        ids = [f"__tie_{c}" for c in table.id]
        right = table.df.withColumnsRenamed(dict(zip(table.id, ids)))
        base = asof_join(
            base, right, table.keys, table.keys, ts, table.ts, ids, table.names,
            table.ttl_seconds, policy=policy,
        ).drop(*ids)
    return base


def _all_set(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).isNotNull()
    return condition


def _carry(stacked: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """For each tile of a heavy key, the newest right row of the tiles before it."""
    helpers = [F.first(h).alias(h) for h in HELPERS if h != TILE]
    newest = F.max_by("__hit", F.when(F.col("__hit").isNotNull(), F.struct("__t", *ids)))
    tiles = stacked.filter(is_heavy()).groupBy(*keys, TILE).agg(newest.alias("__hit"), *helpers)
    earlier = Window.partitionBy(*keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    carry = tiles.withColumn("__hit", F.last("__hit", ignorenulls=True).over(earlier))
    # No time: sorts before every row of the tile.
    return carry.filter((F.col(TILE) >= 0) & F.col("__hit").isNotNull())
