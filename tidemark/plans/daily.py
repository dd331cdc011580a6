"""What a day leaves for later days, so that a run of one date sees windows of weeks without reading weeks of events.

A published date leaves, per key,

* ``state/<name>_seconds``: row counts and sums per second, partitioned by the day of the event,
* ``state/<name>_days``: the same per day, which adds up what the seconds hold,
* ``state/<name>_last``: the newest event of every key so far, for lags.

A trailing window of ``L`` seconds over the events of one day consists of whole days, which every event of the run has in its
window, and of days at the window's far edge, of which each event has another part. So a run reads the *days* between and the
*seconds* at the edge only: for 30 days, 29 small sums and one day of seconds. These come into the same window plan as the
run's own events (:func:`tidemark.operators.history.history`), a sum per day standing at the second before the run, and with
it heavy keys are cut into tiles as ever. All sums are exact, so the results equal those over all events at once.

Runs go forward in time: a date sees the dates before it, in their newest versions, and none of its features is revised when an earlier date is
published anew. ``dt`` may hold late events of days before it, and a first load of many days. Events without a time leave no state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.entities import DAY, latest
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import KeyLoad, SkewPolicy, measure
from tidemark.sources.lake import Lake

SECONDS = "ts_epoch"
_SEEN, _TODAY = "__seen", "__today"


@dataclass(frozen=True)
class KeyState:
    """The windows and lags of one key, and the names under which their state is kept."""

    name: str
    key: str
    rolling: tuple[Rolling, ...]
    lags: tuple[Lag, ...] = ()
    id: str = "t_id"

    @property
    def values(self) -> list[str]:
        return list(dict.fromkeys(r.value for r in self.rolling if r.value is not None))

    def dataset(self, part: str) -> str:
        return f"state/{self.name}_{part}"


@dataclass(frozen=True)
class Reach:
    """The stored days that a window length needs for a run over days ``lo`` to ``hi`` (days since 1970)."""

    since: int  # first second in any of the windows
    edge: tuple[int, ...]  # days read by seconds
    whole: range  # days that lie in every window of the run


def reach(seconds: int, lo: int, hi: int) -> Reach:
    start, end = lo * DAY, (hi + 1) * DAY - 1
    # A day is whole if its first second is still in the window of the run's last one.
    whole = range(min(lo, -((seconds - end) // DAY)), lo)
    first = (start - seconds) // DAY
    return Reach(start - seconds, tuple(d for d in range(first, hi + 1) if d not in whole), whole)


@dataclass(frozen=True)
class Past:
    """Rows of earlier dates for one key's windows. Windows with equal days share a group of value columns."""

    rows: DataFrame
    groups: dict[int, int]  # window length -> group

    def column(self, spec: Rolling) -> str:
        return f"__{spec.value or 'n'}_{self.groups[spec.seconds]}"


def _sum_type(dtype: T.DataType) -> T.DataType:
    return T.DecimalType(min(38, dtype.precision + 10), dtype.scale) if isinstance(dtype, T.DecimalType) else T.LongType()


def _schema(state: KeyState, events: DataFrame, *places: str) -> T.StructType:
    sums = [T.StructField(v, _sum_type(events.schema[v].dataType)) for v in state.values]
    types = {"day": T.IntegerType(), SECONDS: T.LongType()}
    return T.StructType([T.StructField(state.key, events.schema[state.key].dataType), *(T.StructField(p, types[p]) for p in places), T.StructField("n", T.LongType()), *sums])


def _date(day: int) -> str:
    return (date(1970, 1, 1) + timedelta(days=day)).isoformat()


def past_rows(lake: Lake, state: KeyState, dt: str, events: DataFrame) -> Past | None:
    """What earlier dates hold for the windows over ``events``; None where there is no earlier date."""
    if lake.newest_before(state.dataset("seconds"), dt) is None:
        return None
    lo, hi = events.agg(F.min(SECONDS), F.max(SECONDS)).first()
    if lo is None:
        return None
    lo, hi = lo // DAY, hi // DAY
    found: dict[Reach, int] = {}
    groups, parts = {}, []
    for length in sorted({r.seconds for r in state.rolling}):
        own = reach(length, lo, hi)
        same_days = next((r for r in found if (r.edge, r.whole) == (own.edge, own.whole)), None)
        groups[length] = found[same_days] if same_days else found.setdefault(own, len(found))
    # A group reads from the earliest second that one of its windows reaches.
    since = {g: lo * DAY - max(length for length, of in groups.items() if of == g) for g in found.values()}
    for own, g in found.items():
        names = {"n": f"__n_{g}", **{v: f"__{v}_{g}" for v in state.values}}
        by_second = lake.read_days(state.dataset("seconds"), _schema(state, events, "day", SECONDS), _date(min(own.edge)), dt)
        edge = by_second.filter(F.col("day").isin(list(own.edge)) & (F.col(SECONDS) >= since[g]))
        parts.append(edge.select(state.key, SECONDS, *(F.col(c).alias(a) for c, a in names.items())))
        if own.whole:
            by_day = lake.read_days(state.dataset("days"), _schema(state, events, "day"), _date(own.whole.start), dt)
            sums = by_day.filter(F.col("day").between(own.whole.start, own.whole.stop - 1)).groupBy(state.key)
            totals = sums.agg(*(F.sum(c).cast(by_day.schema[c].dataType).alias(a) for c, a in names.items()))
            parts.append(totals.withColumn(SECONDS, F.lit(lo * DAY - 1).cast("bigint")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    rows = rows.withColumn(_SEEN, F.lit(False))
    newest = lake.newest_before(state.dataset("last"), dt)
    if state.lags and newest is not None:
        rows = rows.unionByName(lake.read_prefix(newest).withColumn(_SEEN, F.lit(True)), allowMissingColumns=True)
    return Past(rows.withColumn(_TODAY, F.lit(False)), groups)


def load_of(events: DataFrame, past: Past | None, state: KeyState, policy: SkewPolicy) -> KeyLoad:
    """Rows per key, those of earlier dates included."""
    times = events.select(state.key, SECONDS)
    if past is not None:
        times = times.unionByName(past.rows.select(state.key, SECONDS))
    return measure(times, [state.key], F.col(SECONDS), policy, max(r.seconds for r in state.rolling))


def with_history(events: DataFrame, past: Past | None, state: KeyState, policy: SkewPolicy, load: KeyLoad | None = None) -> DataFrame:
    """``events`` with the state's windows and lags, earlier dates included."""
    if past is None:
        return history(events, [state.key], SECONDS, [state.id], state.rolling, state.lags, policy, load)
    by_name = {past.column(s): s for s in state.rolling}
    specs = [Rolling(s.name, s.seconds, past.column(s), s.prior) for s in state.rolling]

    def own(spec: Rolling) -> Column:
        return F.lit(1).cast("bigint") if spec.value is None else F.col(spec.value).cast(_sum_type(events.schema[spec.value].dataType))

    today = events.withColumns({**{name: own(s) for name, s in by_name.items()}, _SEEN: F.lit(True), _TODAY: F.lit(True)})
    kept = past.rows.select(*(c for c in past.rows.columns if c in today.columns))
    out = history(today.unionByName(kept, allowMissingColumns=True), [state.key], SECONDS, [state.id], specs, state.lags, policy, load, _SEEN)
    # A count over no rows is 0; rows without a time have none.
    counts = {s.name: F.when(F.col(SECONDS).isNotNull(), F.coalesce(s.name, F.lit(0).cast("bigint"))) for s in state.rolling if s.value is None}
    out = out.filter(_TODAY).withColumns(counts) if counts else out.filter(_TODAY)
    return out.select(*events.columns, *(lag.name for lag in state.lags), *(s.name for s in state.rolling))


def publish_state(lake: Lake, dt: str, run_id: str, events: DataFrame, states: Sequence[KeyState]) -> dict[str, str]:
    """Leave the state of one date. ``events`` are its written features, with ``ts_epoch``."""
    out = {}
    timed = events.filter(F.col(SECONDS).isNotNull())
    for state in states:
        name = state.dataset("seconds")
        sums = [F.count(F.lit(1)).alias("n"), *(F.sum(v).cast(_sum_type(events.schema[v].dataType)).alias(v) for v in state.values)]
        by_second = timed.groupBy(state.key, SECONDS).agg(*sums).withColumn("day", F.floor(F.col(SECONDS) / DAY).cast("int"))
        out[name] = lake.publish(by_second.sortWithinPartitions("day", SECONDS), name, dt, run_id, partition_by=["day"])
        schema = _schema(state, events, SECONDS, "day")
        written = lake.spark.read.schema(schema).parquet(f"{lake.root}/{out[name]}")
        added = [F.sum("n").alias("n"), *(F.sum(v).cast(schema[v].dataType).alias(v) for v in state.values)]
        name = state.dataset("days")
        out[name] = lake.publish(written.groupBy(state.key, "day").agg(*added), name, dt, run_id, partition_by=["day"])
        if state.lags:
            name = state.dataset("last")
            columns = list(dict.fromkeys([state.key, SECONDS, state.id, *(lag.column for lag in state.lags if lag.column)]))
            newest, before = timed.select(*columns), lake.newest_before(name, dt)
            if before is not None:
                newest = newest.unionByName(lake.read_prefix(before).select(*columns))
            out[name] = lake.publish(latest(newest, [state.key], SECONDS, [state.id]), name, dt, run_id)
    return out
