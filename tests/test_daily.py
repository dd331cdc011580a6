"""State left by earlier dates against windows over all events at once."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import SkewPolicy
from tidemark.plans import daily
from tidemark.sources.lake import Lake

DAY = 86_400
STATE = daily.KeyState(
    "k",
    "k",
    (
        Rolling("s10m", 600, "v"), Rolling("n10m", 600), Rolling("s36h", 36 * 3600, "v"), Rolling("n2d", 2 * DAY), Rolling("s3d", 3 * DAY, "v"),
        Rolling("p1d", DAY, "w", prior=True), Rolling("p3d", 3 * DAY, "w", prior=True), Rolling("n3d", 3 * DAY, prior=True),
    ),
    (Lag("prev_s"), Lag("prev_w", "w")),
    "id",
)
NAMES = ["id", *(s.name for s in STATE.rolling), *(lag.name for lag in STATE.lags)]


@pytest.mark.parametrize("seconds", [1, 599, DAY - 1, DAY, DAY + 1, 36 * 3600, 3 * DAY, 3 * DAY + 7])
def test_reach_covers_every_window_once(seconds):
    for lo, hi in ((10, 10), (10, 12)):
        found = daily.reach(seconds, lo, hi)
        assert not set(found.edge) & set(found.whole)
        start, end = lo * DAY, (hi + 1) * DAY - 1
        for day in range(0, hi + 1):
            first, last = day * DAY, (day + 1) * DAY - 1
            in_some = last >= start - seconds
            in_all = day < lo and first >= end - seconds
            assert (day in found.whole) == in_all and (day in found.edge) == (in_some and not in_all)


def events(spark, seed):
    pick = random.Random(seed)
    out = []
    for i in range(160):
        day = pick.choice([0, 0, 1, 2, 3, 3, 4, 6])
        at = day * DAY + pick.choice([0, 1, 599, 600, 601, 43_200, DAY - 1, pick.randrange(DAY)])
        out.append((i, pick.choice(["a", "a", "a", "b", "c", None]), at if pick.random() < 0.97 else None, pick.choice([None, Decimal("1.25"), Decimal("-3.10")]), pick.choice([0, 1, None]), day))
    return spark.createDataFrame(out, "id int, k string, ts_epoch bigint, v decimal(18,2), w int, day int")


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(frame_rows=3, tile_rows=8), SkewPolicy(frame_rows=3, tile_rows=8, split_share=1.0)])
def test_day_by_day_equals_all_at_once(spark, tmp_path, policy):
    df = events(spark, policy.tile_rows)
    lake = Lake(spark, str(tmp_path / "lake"))
    got = []
    # A load of two days, single days, and a run of three days.
    for dt, days in (("1970-01-02", (0, 1)), ("1970-01-03", (2,)), ("1970-01-04", (3,)), ("1970-01-07", (4, 5, 6))):
        own = df.filter(F.col("day").isin(*days)).drop("day")
        past = daily.past_rows(lake, STATE, dt, own)
        assert (past is None) == (dt == "1970-01-02")
        out = daily.with_history(own, past, STATE, policy, daily.load_of(own, past, STATE, policy))
        assert out.columns[: len(own.columns)] == own.columns
        got += rows(out.select(*NAMES))
        daily.publish_state(lake, dt, "r", own, [STATE])
    whole = history(df.drop("day"), ["k"], "ts_epoch", ["id"], STATE.rolling, STATE.lags)
    # A row without a time has no place among the events of other dates: its lag is not compared.
    timeless = {r["id"] for r in df.filter("ts_epoch is null").collect()}
    expected = rows(whole.select(*NAMES))
    width = 1 + len(STATE.rolling)
    keep = lambda found: sorted((r[:width] if r[0] in timeless else r for r in found), key=repr)
    first_of_null = lambda found: [r for r in found if r[0] not in timeless]
    assert [r[:width] for r in keep(got)] == [r[:width] for r in keep(expected)]
    nulls_before = {r["id"] for r in df.filter("ts_epoch is null").collect()}
    assert len(first_of_null(got)) == len(first_of_null(expected)) == 160 - len(nulls_before)
    lags = {r[0]: r[width:] for r in first_of_null(got)}
    for row in first_of_null(expected):
        if row[width] is not None:  # else the event before it has no time, or there is none
            assert lags[row[0]] == row[width:]


def test_far_days_are_read_as_sums(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    one = lambda day: spark.createDataFrame([(day, "a", day * DAY + 5, Decimal(1), 1)], "id int, k string, ts_epoch bigint, v decimal(18,2), w int")
    for day in range(5):
        daily.publish_state(lake, daily._date(day), "r", one(day), [STATE])
    past = daily.past_rows(lake, STATE, daily._date(5), one(5))
    files = [f.split("/lake/")[1] for f in past.rows.inputFiles()]
    seconds = {f.split("day=")[1][0] for f in files if f.startswith("state/k_seconds")}
    # The last day for windows up to a day, day 3 for one and a half and two days, day 2 for three: days 3 and 4 of the
    # three-day windows come from sums.
    plan = past.rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day#" in plan and seconds
    read = past.rows.filter("not __seen").select("ts_epoch").distinct()
    assert sorted(r[0] // DAY for r in read.collect()) == [2, 3, 4, 4]
