from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import SkewPolicy, add_tile, measure

SCHEMA = "id long, k string, s long, amount decimal(18,2), y int, tag string"
SPECS = [
    Rolling("sum10", 10, "amount"),
    Rolling("cnt10", 10),
    Rolling("sum40", 40, "amount"),
    Rolling("prior5", 5, "y", prior=True),
    Rolling("prior30", 30, "y", prior=True),
    Rolling("prior_cnt", 30, None, prior=True),
    Rolling("ever", None, "y"),
]
LAGS = [Lag("prev_s"), Lag("prev_tag", "tag")]
POLICIES = {
    "sliding": SkewPolicy(frame_rows=1000),
    "running": SkewPolicy(frame_rows=0),
    "tiled": SkewPolicy(frame_rows=0, tile_rows=3),
    "split": SkewPolicy(frame_rows=3, tile_rows=6, split_share=1.0),
    "list_too_short": SkewPolicy(frame_rows=2, tile_rows=6, max_keys=1),
}


def brute(events):
    out = []
    for i, k, s, _a, _y, _t in events:
        mine = [e for e in events if e[1] == k]

        def total(position, seconds, prior, mine=mine, s=s):
            if s is None:
                return None
            lo = -(10**9) if seconds is None else s - seconds
            hi = s - 1 if prior else s
            inside = [e for e in mine if e[2] is not None and lo <= e[2] <= hi]
            if position is None:
                return len(inside)
            values = [e[position] for e in inside if e[position] is not None]
            return sum(values) if values else None

        money = [total(3, 10, False), total(3, 40, False)]
        money = [None if m is None else float(m) for m in money]
        ordered = sorted(mine, key=lambda e: (e[2] is not None, e[2] or 0, e[0]))
        at = [e[0] for e in ordered].index(i)
        prev = ordered[at - 1] if at else None
        out.append(
            (i, prev and prev[2], prev and prev[5], money[0], total(None, 10, False), money[1], total(4, 5, True),
             total(4, 30, True), total(None, 30, True), total(4, None, False))
        )
    return sorted(out, key=repr)


def run(spark, events, policy):
    df = spark.createDataFrame(events, SCHEMA)
    out = history(df, ["k"], "s", ["id"], SPECS, LAGS, policy)
    assert out.columns == [*df.columns, "prev_s", "prev_tag", *(s.name for s in SPECS)]
    return rows(out.drop("k", "s", "amount", "y", "tag"))


EVENT = st.tuples(
    st.sampled_from(["a", "a", "a", "b", None]),
    st.one_of(st.integers(0, 100), st.integers(50, 60), st.none()),
    st.one_of(st.none(), st.integers(-500, 5000).map(lambda n: Decimal(n) / 100)),
    st.one_of(st.none(), st.integers(0, 1)),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(st.lists(EVENT, min_size=1, max_size=25))
def test_all_plans_equal_brute_force(spark, drawn):
    events = [(i, k, s, a, y, f"t{i}") for i, (k, s, a, y) in enumerate(drawn)]
    expected = brute(events)
    for name, policy in POLICIES.items():
        assert run(spark, events, policy) == expected, name


@pytest.mark.parametrize("name", POLICIES)
def test_peers_and_empty_frames(spark, name):
    money = Decimal("1.10")
    events = [(1, "a", 100, money, 1, "x"), (2, "a", 100, money, 1, "y"), (3, "b", 5, money, 0, "z")]
    got = {r[0]: r for r in run(spark, events, POLICIES[name])}
    # Events of one second see each other in [-s, 0] and not in [-s, -1].
    assert got[1][3:6] == (2.2, 2, 2.2) and got[2][3:6] == (2.2, 2, 2.2)
    assert got[1][6:9] == (None, None, 0)
    # The first event of a key has no previous one; ties are ordered by id.
    assert got[1][1:3] == (None, None) and got[2][1:3] == (100, "x") and got[3][1:3] == (None, None)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 1)), min_size=2, max_size=20), st.integers(0, 40))
def test_labels_from_now_on_never_matter(spark, drawn, cut):
    specs = [Rolling("p", 15, "y", prior=True)]

    def priors(events):
        df = spark.createDataFrame(events, "id long, k string, s long, y int")
        return {r.id: r.p for r in history(df, ["k"], "s", ["id"], specs, policy=POLICIES["tiled"]).collect()}

    before = priors([(i, "a", s, y) for i, (s, y) in enumerate(drawn)])
    flipped = priors([(i, "a", s, 1 - y if s >= cut else y) for i, (s, y) in enumerate(drawn)])
    for i, (s, _) in enumerate(drawn):
        if s <= cut:
            assert before[i] == flipped[i]


def test_floats_are_refused(spark):
    df = spark.createDataFrame([(1, "a", 1, 0.5)], "id long, k string, s long, v double")
    with pytest.raises(ContractError, match="decimal"):
        history(df, ["k"], "s", ["id"], [Rolling("x", 5, "v")])


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[-1].count("Exchange hashpartitioning"), plan


def test_light_keys_need_one_exchange_and_one_sort(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(1000).selectExpr(
        "id", "cast(id % 7 as string) k", "id s", "cast(1 as decimal(18,2)) amount", "1 y", "'t' tag"
    ).write.parquet(path)
    df = history(spark.read.parquet(path), ["k"], "s", ["id"], SPECS, LAGS)
    n, plan = exchanges(df)
    assert n == 1 and plan.count("Sort [") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    # Heavy keys: the rows still move once, by (key, tile); the other exchanges carry tile totals.
    heavy = history(spark.read.parquet(path), ["k"], "s", ["id"], SPECS, LAGS, SkewPolicy(10, 20))
    _, plan = exchanges(heavy)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tiles_hold_about_as_many_rows_however_uneven_the_times(spark):
    policy = SkewPolicy(frame_rows=50, tile_rows=1000)
    spread = spark.range(20_000).selectExpr("'a' k", "id + 1000000000 s")
    odd_clock = spread.unionByName(spark.sql("select 'a' k, 0L s"))
    burst = spark.range(20_000).selectExpr("'a' k", "1000000000 + cast(pow(id / 20000, 6) * 100000000 as long) s")
    by_day = spark.range(20_000).selectExpr("'a' k", "1000000000 + (id % 40) * 86400 s")
    for df, most in ((spread, 2000), (odd_clock, 2000), (burst, 4000), (by_day, 2000)):
        load = measure(df, ["k"], F.col("s"), policy)
        sizes = add_tile(df, load, F.col("s")).groupBy("__tile").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.first("__tile_start").alias("start"))
        tiles = sizes.orderBy("__tile").collect()
        assert sum(t.n for t in tiles) == df.count() and max(t.n for t in tiles) <= most
        assert all(t.start <= t.lo for t in tiles) and all(a.hi < b.start for a, b in zip(tiles, tiles[1:]))
    # One early row does not hide a dense hour.
    dense = spark.range(400).selectExpr("'a' k", "id + 1000000000 s").unionByName(spark.sql("select 'a' k, 0L s"))
    assert measure(dense, ["k"], F.col("s"), policy, reach=100).any_listed
    assert not measure(dense, ["k"], F.col("s"), policy, reach=10).any_listed
