from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators.asof import FeatureTable, asof_join, asof_join_all, best_per_left_id
from tidemark.operators.tiles import SkewPolicy

T0 = datetime(2024, 1, 1)
LEFT, RIGHT = "lid long, k string, t timestamp_ntz", "k string, t timestamp_ntz, rid long, v string"
POLICIES = {"plain": SkewPolicy(), "tiled": SkewPolicy(0, 2), "one_tiled": SkewPolicy(1, 4, 1)}


def at(half_seconds):
    return None if half_seconds is None else T0 + timedelta(seconds=half_seconds / 2)


def brute(left, right, exact=True, ttl=None):
    out = []
    for lid, k, t in left:
        ok = [
            r
            for r in right
            if None not in (k, t, r[0], r[1]) and r[0] == k and (r[1] <= t if exact else r[1] < t)
        ]
        best = max(ok, key=lambda r: (r[1], r[2]), default=None)
        if best and ttl is not None and best[1] < t - timedelta(seconds=ttl):
            best = None
        out.append((lid, k, t, best and best[2], best and best[3]))
    return sorted(out, key=repr)


KEY = st.sampled_from(["a", "a", "b", None])
TIME = st.one_of(st.integers(0, 40), st.none())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(
    st.lists(st.tuples(KEY, TIME), max_size=15),
    st.lists(st.tuples(KEY, TIME, st.one_of(st.none(), st.just("v"))), max_size=15),
    st.booleans(),
    st.sampled_from([None, 3]),
)
def test_equals_brute_force(spark, drawn_left, drawn_right, exact, ttl):
    left = [(i, k, at(t)) for i, (k, t) in enumerate(drawn_left)]
    right = [(k, at(t), i, v) for i, (k, t, v) in enumerate(drawn_right)]
    l_df, r_df = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    for name, policy in POLICIES.items():
        got = asof_join(
            l_df, r_df, ["k"], ["k"], "t", "t", ["rid"], ttl_seconds=ttl, allow_exact=exact, policy=policy
        )
        assert rows(got) == brute(left, right, exact, ttl), name


def test_edges(spark):
    left = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(9)), (3, "b", at(10))], LEFT)
    micro = at(10) + timedelta(microseconds=1)
    right = spark.createDataFrame(
        [("a", at(10), 1, "low"), ("a", at(10), 2, "high"), ("a", micro, 3, "later"), ("b", micro, 4, "late")], RIGHT
    )
    got = {r.lid: r.v for r in asof_join(left, right, ["k"], ["k"], "t", "t", ["rid"]).collect()}
    assert got == {1: "high", 2: None, 3: None}


def test_ttl_edge(spark):
    left = spark.createDataFrame([(1, "a", at(20)), (2, "a", at(22))], LEFT)
    right = spark.createDataFrame([("a", at(0), 1, "x")], RIGHT)
    got = asof_join(left, right, ["k"], ["k"], "t", "t", ttl_seconds=10)
    assert {r.lid: r.v for r in got.collect()} == {1: "x", 2: None}


def test_duplicate_left_rows_stay_and_can_be_ranked(spark):
    left = spark.createDataFrame([(1, "a", at(4)), (1, "a", at(8)), (2, "b", at(1))], LEFT)
    right = spark.createDataFrame([("a", at(2), 1, "x"), ("a", at(6), 2, "y")], RIGHT)
    joined = asof_join(left, right, ["k"], ["k"], "t", "t", matched_ts="rt")
    assert joined.count() == 3
    best = best_per_left_id(joined, ["lid"], "rt")
    assert {r.lid: r.v for r in best.collect()} == {1: "y", 2: None}


def test_names_of_output_columns(spark):
    left = spark.createDataFrame([(1, "a", at(4))], LEFT)
    right = spark.createDataFrame([("a", at(2), 7, "x")], "k string, t timestamp_ntz, lid long, m_v string")
    with pytest.raises(ContractError, match="lid"):
        asof_join(left, right, ["k"], ["k"], "t", "t")
    both = asof_join_all(left, [FeatureTable(right, ("k",), "t", {"m_v": "merchant_v"}, ("lid",))], "t")
    assert both.columns == ["lid", "k", "t", "merchant_v"] and both.first().merchant_v == "x"
    with pytest.raises(ContractError, match="not carry"):
        asof_join(left, right, ["k"], ["k"], "t", "t", names={"other": "o"})
    with pytest.raises(ContractError, match="repeat columns ..k"):
        asof_join(left, right, ["k"], ["k"], "t", "t", names={"lid": "rid", "m_v": "k"})
    with pytest.raises(ContractError, match="repeat columns ..at"):
        asof_join(left, right, ["k"], ["k"], "t", "t", names={"lid": "at"}, matched_ts="at")


def test_no_pairs_are_formed(spark, tmp_path):
    for name, step in (("l", 3), ("r", 5)):
        spark.range(500).selectExpr(
            f"id {name}id", "cast(id % 5 as string) k", f"timestamp_seconds(id * {step}) t"
        ).write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "lr")
    plan = asof_join(left, right, ["k"], ["k"], "t", "t", ["rid"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
