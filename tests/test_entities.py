from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators.entities import (
    FeatureView,
    card_view,
    latest,
    lookup,
    materialize,
    materialize_increment,
    merchant_view,
    missing_values,
)
from tidemark.operators.events import attach_labels, normalize, stack

T0 = datetime(2024, 1, 1)
VIEW = FeatureView("v", ("k",), {"x": T.FloatType(), "n": T.LongType()}, ttl_seconds=10)
SCHEMA = "k string, event_ts timestamp_ntz, x double, n int, id long"


def at(s):
    return T0 + timedelta(seconds=s)


def lit(s):
    return F.lit(at(s).isoformat(" ")).cast("timestamp_ntz")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30)), max_size=20), st.integers(0, 30))
def test_two_windows_equal_one(spark, drawn, middle):
    df = spark.createDataFrame([(k, at(s), s / 3, s, i) for i, (k, s) in enumerate(drawn)], SCHEMA)
    one = materialize(df, VIEW, lit(0), lit(25), ["id"])
    first = materialize(df, VIEW, lit(0), lit(min(middle, 25)), ["id"])
    two = materialize_increment(first, df, VIEW, lit(min(middle, 25)), lit(25), ["id"])
    assert rows(two) == rows(one) and two.schema == one.schema
    assert all(r.event_ts <= at(25) for r in one.collect())


def test_view_types_and_contract(spark):
    df = spark.createDataFrame([("a", at(1), 0.1, 2, 1)], SCHEMA)
    row = materialize(df, VIEW, lit(0), lit(5)).first()
    assert row.x == pytest.approx(0.1, rel=1e-6) and row.x != 0.1
    with pytest.raises(ContractError, match="lacks"):
        VIEW.check(df.drop("n"))
    with pytest.raises(ContractError, match="x is string"):
        VIEW.check(df.withColumn("x", F.lit("t")))
    assert len(card_view().fields) == 9 and card_view().ttl_seconds == 30 * 86_400
    assert list(merchant_view().fields) == ["m_fraud_cnt_1d", "m_fraud_cnt_7d", "m_fraud_cnt_30d"]


def test_latest_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("a", at(1), 1.0, 1, 1), ("a", at(1), 2.0, 2, 2), ("b", None, 3.0, 3, 3)], SCHEMA)
    assert {r.k: r.n for r in latest(df, ["k"], "event_ts", ["id"]).collect()} == {"a": 2, "b": 3}
    plan = latest(df, ["k"], "event_ts", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_lookup(spark):
    online = VIEW.project(
        spark.createDataFrame([("a", at(0), 1.0, 1, 1), ("b", at(20), 2.0, 2, 2), ("c", at(9), 3.0, 3, 3)], SCHEMA)
    )
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("zz",), ("b",)], "k string")
    got = lookup(asked, {"v": (VIEW, online)}, ["v:n", "v:x"], lit(20))
    # a: 20 s old, ttl 10; c: 11 s old; zz: unknown.
    assert rows(got) == sorted([("a", None, None), ("b", 2, 2.0), ("b", 2, 2.0), ("c", None, None), ("zz", None, None)], key=repr)
    edge = lookup(asked.filter("k = 'c'"), {"v": (VIEW, online)}, ["v:n"], lit(19))
    assert edge.first().n == 3
    short = lookup(asked.filter("k = 'c'"), {"v": (VIEW, online)}, ["v:n"], lit(19), key_ttl_seconds=9)
    assert rows(missing_values(short, ["k"], ["n"])) == [("c", "n")]
    with pytest.raises(ContractError, match="v:nope"):
        lookup(asked, {"v": (VIEW, online)}, ["v:nope"], lit(20))


def test_label_join_and_shaping(spark):
    tx = spark.createDataFrame([("1",), ("2",)], "t_id string")
    labels = spark.createDataFrame([("2", "x"), ("2", "y"), ("9", "z")], "t_id string, explanation string")
    out = attach_labels(tx, labels)
    assert out.columns == ["t_id", "label_is_fraud"] and rows(out) == [("1", 0), ("2", 1)]
    both = stack([tx, labels])
    assert both.columns == ["t_id", "explanation"] and both.count() == 5
    text = spark.createDataFrame([("2024-01-01T00:00:01.9Z",), ("x",)], "ts string")
    assert [r.ts_epoch for r in normalize(text).collect()] == [1704067201, None]
