"""Features of an event from the earlier events of its key: trailing sums and counts, lags, recency."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ContractError, require
from tidemark.operators.tiles import (
    DEFAULT_POLICY,
    HELPERS,
    TILE,
    KeyLoad,
    SkewPolicy,
    add_tile,
    is_heavy,
    measure,
    split_by_load,
    tile_opening_second,
    within_key_span,
)


@dataclass(frozen=True)
class Rolling:
    """One trailing aggregate over ``[t - seconds, t]``, or ``[t - seconds, t - 1]`` when ``prior``.

    Bounds are whole seconds and inclusive, so events of the same second see each other in the first
    form and do not in the second. ``value=None`` counts rows. ``seconds=None`` reaches back without
    limit. A sum over no values is NULL, a count over no rows is 0.
    """

    name: str
    seconds: int | None
    value: str | None = None
    prior: bool = False


@dataclass(frozen=True)
class Lag:
    """Value of ``column`` on the previous event of the key; ``column=None`` takes its epoch second."""

    name: str
    column: str | None = None


def history(
    df: DataFrame,
    keys: Sequence[str],
    seconds: str,
    order_id: Sequence[str],
    rolling: Sequence[Rolling] = (),
    lags: Sequence[Lag] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
    load: KeyLoad | None = None,
    seen: str | None = None,
) -> DataFrame:
    """Add the asked-for columns to every row of ``df``.

    ``seen`` names a boolean column: rows where it is not true add to the sums, but are no event for the lags.

    ``seconds`` is the epoch-second column, ``order_id`` breaks ties between events of one second for
    the lags. Summed columns must be integral or decimal: both plans below then give the same exact
    result. Decimal sums come back as double.

    Sparse keys: one exchange on the keys, one sort, sliding frames. A sliding frame re-adds its rows for
    every row, so dense keys (over ``policy.frame_rows`` rows in the longest frame) get running totals
    instead: each event also emits one narrow row per window length at the second it *leaves* that
    window, and a trailing sum is the running total of arrivals minus that of departures. If the dense
    keys are the smaller part of the table, they are computed apart from the rest. Keys above
    ``policy.tile_rows`` are cut into time tiles on top (see :mod:`tidemark.operators.tiles`).
    """
    require(df, [*keys, seconds, *order_id, *(r.value for r in rolling if r.value)])
    plan = _Plan(df.columns, df.schema, tuple(keys), seconds, tuple(order_id), tuple(rolling), tuple(lags), seen)
    load = load or measure(df, keys, F.col(seconds), policy, plan.reach)
    if not load.any_listed:
        return plan.sliding(df)
    if plan.reach is None or not load.splits:
        return plan.running(df, load)
    dense, sparse = split_by_load(df, load)
    return plan.running(dense, load).unionByName(plan.sliding(sparse))


class _Plan:
    def __init__(self, columns, schema, keys, seconds, order_id, rolling, lags, seen=None):
        self.columns, self.keys, self.seconds, self.order_id = columns, keys, seconds, order_id
        self.rolling, self.lags, self.seen = rolling, lags, seen
        self.types = {f.name: f.dataType for f in schema}
        self.values = list(dict.fromkeys(r.value for r in rolling))
        self.reach = max((r.seconds for r in rolling if r.seconds is not None), default=None)
        for v in self.values:
            if v is not None and not isinstance(self.types[v], (T.IntegralType, T.DecimalType)):
                raise ContractError(f"{v}: cast to decimal or integer before rolling sums")

    # -- shared pieces ---------------------------------------------------------------------------

    def _whole(self, value: str | None) -> Column:
        """The summed column as a whole number (cents for money): long sums are exact and cheap.

        NULL for rows without a time: they are in nobody's past.
        """
        if value is None:
            number = F.lit(1)
        elif isinstance(self.types[value], T.DecimalType):
            number = F.col(value) * F.lit(10 ** self.types[value].scale)
        else:
            number = F.col(value)
        return F.when(F.col(self.seconds).isNotNull(), number.cast("long"))

    def _final(self, spec: Rolling, total: Column) -> Column:
        dtype = self.types.get(spec.value) if spec.value else None
        if isinstance(dtype, T.DecimalType) and dtype.scale:
            total = (total.cast("decimal(20,0)") / F.lit(10**dtype.scale)).cast("double")
        elif isinstance(dtype, T.DecimalType):
            total = total.cast("double")
        return F.when(F.col(self.seconds).isNotNull(), total).alias(spec.name)

    # -- sparse keys ------------------------------------------------------------------------------

    def sliding(self, df: DataFrame) -> DataFrame:
        by_time = Window.partitionBy(*self.keys).orderBy(self.seconds)
        by_row = Window.partitionBy(*self.keys).orderBy(self.seconds, *self.order_id)
        # Lags first: the finer sort order they need also serves the range frames.
        if self.seen is None or not self.lags:
            previous = {lag.name: F.lag(lag.column or self.seconds, 1).over(by_row) for lag in self.lags}
            out = df.withColumns(previous)
        else:
            fields = F.struct(*(F.col(lag.column or self.seconds).alias(f"l{i}") for i, lag in enumerate(self.lags)))
            earlier_rows = by_row.rowsBetween(Window.unboundedPreceding, -1)
            out = df.withColumn("__prev", F.last(F.when(F.col(self.seen), fields), ignorenulls=True).over(earlier_rows))
            out = out.withColumns({lag.name: F.col(f"__prev.l{i}") for i, lag in enumerate(self.lags)}).drop("__prev")
        columns = {}
        for spec in self.rolling:
            start = Window.unboundedPreceding if spec.seconds is None else -spec.seconds
            frame = by_time.rangeBetween(start, -1 if spec.prior else 0)
            aggregate = F.count if spec.value is None else F.sum
            columns[spec.name] = self._final(spec, aggregate(self._whole(spec.value)).over(frame))
        return out.withColumns(columns)

    # -- dense keys ------------------------------------------------------------------------------

    def running(self, df: DataFrame, load: KeyLoad) -> DataFrame:
        rows = self._arrivals_and_departures(df)
        part = list(self.keys)
        if load.tiled:
            rows = add_tile(rows, load, F.col("__at")).filter(
                F.col("__row").isNotNull() | within_key_span(F.col("__at"))
            )
            rows = rows.unionByName(self._carry(rows), allowMissingColumns=True)
            part.append(TILE)
        # Moved and sorted while narrow; the columns the windows add up are spread out after that.
        rows = rows.select(*[c for c in rows.columns if c not in HELPERS or c == TILE])
        rows = rows.repartition(*part).sortWithinPartitions(*part, "__at", *self._ids)
        rows = rows.withColumns(self._spread(tiled=load.tiled))

        by_time = Window.partitionBy(*part).orderBy("__at")
        upto = by_time.rangeBetween(Window.unboundedPreceding, 0)
        before = by_time.rangeBetween(Window.unboundedPreceding, -1)
        if self.lags:
            by_row = Window.partitionBy(*part).orderBy("__at", *self._ids)
            earlier_rows = by_row.rowsBetween(Window.unboundedPreceding, -1)
            rows = rows.withColumn("__prev", F.last("__lag", ignorenulls=True).over(earlier_rows))
        totals = {}
        for i, spec in enumerate(self.rolling):
            v = self.values.index(spec.value)
            arrived = F.coalesce(F.sum(f"__in{v}").over(before if spec.prior else upto), F.lit(0))
            left = F.lit(0)
            if spec.seconds is not None:
                left = F.coalesce(F.sum(f"__out{i}").over(upto), F.lit(0))
            total = arrived - left
            if spec.value is not None:
                last_seen = F.max(f"__seen{v}").over(before if spec.prior else upto)
                reached = last_seen.isNotNull()
                if spec.seconds is not None:
                    reached = reached & (last_seen >= F.col("__at") - spec.seconds)
                total = F.when(reached, total)
            totals[f"__t{i}"] = total
        rows = rows.withColumns(totals).filter(F.col("__row").isNotNull())
        return rows.select(
            "__row.*",
            *(F.col(f"__prev.l{i}").alias(lag.name) for i, lag in enumerate(self.lags)),
            *(F.col(f"__t{i}") for i in range(len(self.rolling))),
        ).select(
            *self.columns,
            *(lag.name for lag in self.lags),
            *(self._final(spec, F.col(f"__t{i}")) for i, spec in enumerate(self.rolling)),
        )

    @property
    def _ids(self) -> list[str]:
        return [f"__id{i}" for i in range(len(self.order_id))] if self.lags else []

    def _arrivals_and_departures(self, df: DataFrame) -> DataFrame:
        """One row per event plus one narrow row per window length at the second it drops out.

        ``__after`` is 0 for the event itself and window length + 1 for a departure; ``__v<j>`` is what
        arrives or departs.
        """
        whole = [self._whole(v) for v in self.values]
        moves = [F.lit(0).cast("long")]
        for length in sorted({r.seconds for r in self.rolling if r.seconds is not None}):
            used = {self.values.index(r.value) for r in self.rolling if r.seconds == length}
            # A window that adds up this event only as 0 or NULL need not hear of its departure.
            counts = [F.coalesce(whole[j], F.lit(0)) != 0 for j in sorted(used)]
            moves.append(F.when(reduce(Column.__or__, counts), F.lit(length + 1).cast("long")))
        packed = df.select(
            F.struct(*self.columns).alias("__row"),
            *self.keys,
            F.col(self.seconds).alias("__s"),
            *(F.col(c).alias(name) for c, name in zip(self.order_id, self._ids)),
            *(w.alias(f"__v{j}") for j, w in enumerate(whole)),
            F.explode(F.array_compact(F.array(*moves))).alias("__after"),
        )
        arrives = F.col("__after") == 0
        return packed.select(
            F.when(arrives, F.col("__row")).alias("__row"),
            *self.keys,
            (F.col("__s") + F.col("__after")).alias("__at"),
            *(F.when(arrives, F.col(name)).alias(name) for name in self._ids),
            *(f"__v{j}" for j in range(len(whole))),
            "__after",
        )

    def _spread(self, tiled: bool) -> dict[str, Column]:
        """Window inputs: arrivals and last seconds per value, departures per window, lag values."""

        def carried(name: str, own: Column) -> Column:
            return F.coalesce(own, F.col(f"__carry.{name}")) if tiled else own

        out = {}
        arrives = F.col("__after") == 0
        for j, v in enumerate(self.values):
            value = F.col(f"__v{j}")
            out[f"__in{j}"] = carried(f"in{j}", F.when(arrives, value))
            if v is not None:
                out[f"__seen{j}"] = carried(f"seen{j}", F.when(arrives & value.isNotNull(), F.col("__at")))
        for i, spec in enumerate(self.rolling):
            if spec.seconds is not None:
                value = F.col(f"__v{self.values.index(spec.value)}")
                out[f"__out{i}"] = carried(f"out{i}", F.when(F.col("__after") == spec.seconds + 1, value))
        if self.lags:
            fields = [F.col(f"__row.{lag.column or self.seconds}").alias(f"l{i}") for i, lag in enumerate(self.lags)]
            out["__lag"] = carried("lag", F.when(self._is_event(), F.struct(*fields)))
        return out

    def _is_event(self) -> Column:
        event = F.col("__row").isNotNull()
        return event if self.seen is None else event & F.col(f"__row.{self.seen}")

    def _carry(self, rows: DataFrame) -> DataFrame:
        """For each tile of a heavy key, carry rows with what the tiles before it add up to.

        Totals and the newest event come from two aggregates, hence as two rows: the totals of all
        arrivals and departures are combined by hash, only the newest event per tile needs a sort.
        """
        spread = {name[2:]: column for name, column in self._spread(tiled=False).items()}
        lag = spread.pop("lag", None)
        heavy = rows.filter(is_heavy())
        helpers = [F.first(h).alias(h) for h in HELPERS if h != TILE]
        earlier = Window.partitionBy(*self.keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)

        def opened(tiles: DataFrame, carried: dict[str, Column]) -> DataFrame:
            carry = tiles.withColumns(carried).filter(F.col(TILE) >= 0)
            fields = [F.col(n) if n in carried else F.lit(None).cast("long").alias(n) for n in spread]
            if lag is not None:
                fields.append(F.col("lag") if "lag" in carried else F.lit(None).cast(lag_type).alias("lag"))
            return carry.select(
                *self.keys, *HELPERS, F.struct(*fields).alias("__carry"), tile_opening_second().alias("__at")
            )

        parts = []
        if lag is not None:
            lag_type = heavy.select(lag.alias("lag")).schema["lag"].dataType
            newest = F.max_by(lag, F.struct("__at", *self._ids))
            events = heavy.filter(self._is_event())
            last_event = events.groupBy(*self.keys, TILE).agg(newest.alias("lag"), *helpers)
            parts.append(opened(last_event, {"lag": F.last("lag", ignorenulls=True).over(earlier)}))
        if spread:
            add = {name: F.max if name.startswith("seen") else F.sum for name in spread}
            inputs = heavy.select(*self.keys, *HELPERS, *(c.alias(n) for n, c in spread.items()))
            totals = inputs.groupBy(*self.keys, TILE).agg(*(f(n).alias(n) for n, f in add.items()), *helpers)
            parts.append(opened(totals, {n: f(n).over(earlier) for n, f in add.items()}))
        return reduce(DataFrame.unionByName, parts)
