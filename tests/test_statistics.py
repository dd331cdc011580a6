import math

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.metrics import average_precision, roc_auc
from tidemark.operators import metrics, ordered, prepare, profile
from tidemark.operators.ordered import TilePolicy

TINY = TilePolicy(tile_rows=3, max_tiles=5)
FEW = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    if not pos or not neg:
        return math.nan
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def precision(pairs):
    positives = sum(y for _, y in pairs)
    if positives in (0, len(pairs)):
        return math.nan
    total = 0.0
    for s in {s for s, _ in pairs}:
        here, upto = [y for t, y in pairs if t == s], [y for t, y in pairs if t >= s]
        total += sum(here) / positives * sum(upto) / len(upto)
    return total


@settings(**FEW)
@given(st.lists(st.tuples(st.integers(0, 12).map(lambda n: n / 12), st.integers(0, 1)), min_size=1, max_size=30))
def test_ranking_metrics(spark, pairs):
    df = spark.createDataFrame(pairs, "score double, label int")
    for policy in (ordered.DEFAULT_TILES, TINY):
        assert metrics.roc_auc(df, policy=policy).first()[0] == pytest.approx(auc(pairs), nan_ok=True)
        assert metrics.average_precision(df, policy=policy).first()[0] == pytest.approx(precision(pairs), nan_ok=True)


def test_extreme_rankings(spark):
    df = spark.createDataFrame([(i / 10, int(i >= 5)) for i in range(10)], "score double, label int")
    assert metrics.roc_auc(df).first()[0] == 1.0 and metrics.average_precision(df).first()[0] == 1.0
    inverted = df.withColumn("score", -F.col("score"))
    assert metrics.roc_auc(inverted).first()[0] == 0.0
    tied = df.withColumn("score", F.lit(0.3))
    assert metrics.roc_auc(tied).first()[0] == 0.5 and metrics.average_precision(tied).first()[0] == 0.5


@settings(**FEW)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40))
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    known = [v for v in values if v is not None]
    wanted = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    for policy in (ordered.DEFAULT_TILES, TINY):
        if known:
            got = ordered.quantiles(df, "x", wanted, policy).first()
            assert list(got) == pytest.approx([float(np.quantile(known, p)) for p in wanted.values()])
        median = prepare.medians(df, ["x"], policy)["x"]
        assert median == (pytest.approx(float(np.median(known))) if known else None)
    k = ordered.kth_smallest(df, F.col("x"), 2, TINY)
    assert k == (sorted(known)[1] if len(known) > 1 else None)


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, "a", 0, None), (2, "a", 1, 3), (2, "b", None, 5), (4, None, 0, 7)], "i int, k string, y int, v int"
    )
    assert profile.null_profile(df, top=2).collect()[0].n_null == 1
    assert [r.column_name for r in profile.null_profile(df, top=None).collect()] == ["k", "v", "y", "i"]
    assert {r.pct_null for r in profile.null_profile(df.limit(0)).collect()} == {0.0}
    assert profile.duplicate_rows(df, ["i"]).first()[0] == 1 and profile.duplicate_rows(df.limit(0), ["i"]).first()[0] == 0
    assert profile.distinct_keys(df, ["i", "k"]).first().asDict() == {"n_i": 3, "n_k": 2}
    assert profile.distinct_keys(df, ["i"], approximate=True).first()[0] == 3
    assert profile.coverage(df, {"v": "v"}).first().asDict() == {"n_rows": 4, "v_covered": 3}
    assert profile.sample_per_group(df, "y", ["i"], 1).count() == 3
    assert {r.n_records for r in profile.preview(df, ["i", "k"], 3).collect()} == {4}
    assert profile.shape(df).first().asDict() == {"n_rows": 4, "n_cols": 4}


def test_rates(spark):
    tx, none = spark.range(4).withColumnRenamed("id", "t_id"), spark.range(0).withColumnRenamed("id", "t_id")
    assert metrics.realised_rate(tx, tx.filter("t_id < 1")).first().realised_rate == 0.25
    assert metrics.realised_rate(none, none).first().realised_rate == 0.0


def test_rows_without_a_label_do_not_count(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.1, 0), (0.95, None), (0.1, None)], "score double, label int")
    assert roc_auc(scored).first()[0] == 1.0 and average_precision(scored).first()[0] == 1.0
