"""Order statistics of many groups at once, and the proof of a written order."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.events import order_inversions, sorted_by_time
from tidemark.operators.ordered import TilePolicy, order_statistics
from tidemark.operators.prepare import bounded, class_medians, stratified_split, with_class_weight


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_ranks_of_many_groups(spark, kind):
    pick = random.Random(2)
    wild = [0.0, -0.0, 1e300, -1e300, 1e-300, 5e-324, float("inf"), float("-inf"), 1.5, 1.5, 1.5, -2.25]
    whole = [0, 2**63 - 1, -(2**63), 2**60, 2**60 + 1, 2**60 + 2, 7, 7, 7, -1]
    data = {"a": wild * 3 if kind == "double" else whole * 3, None: [4] * 9, "b": [pick.randrange(50) for _ in range(400)], "c": [3]}
    values = [(g, float(v) if kind == "double" else v) for g, vs in data.items() for v in vs]
    wanted = [(g, r) for g, vs in data.items() for r in {0, 1, len(vs) // 2, len(vs) - 1}] + [("a", -1), ("c", 1), ("none", 0)]
    df, ranks = spark.createDataFrame(values, f"g string, v {kind}"), spark.createDataFrame(wanted, "g string, rank bigint")
    expected = sorted(((g, r, sorted(data[g])[r] + 0) for g, r in wanted if g in data and 0 <= r < len(data[g])), key=repr)
    for policy in (TilePolicy(), TilePolicy(tile_rows=5)):
        found = [(g, r, v + 0) for g, r, v in rows(order_statistics(df, ranks, ["g"], policy))]
        assert sorted(found, key=repr) == expected
    assert order_statistics(df.limit(0), ranks, ["g"]).count() == 0


def test_many_classes(spark):
    """No list of classes: 3,000 of them are split, bounded and weighed."""
    df = spark.range(9_000).select(F.col("id").alias("t"), (F.col("id") % 3_000).alias("y"))
    assert stratified_split(df, "t", "y", 1 / 3).groupBy("y").agg(F.count_if("is_test").alias("n")).filter("n <> 1").count() == 0
    assert bounded(df, "t", "y", 6_000, 1).groupBy("y").count().filter("count <> 2").count() == 0
    assert with_class_weight(df, "y").filter("weight <> 1.0").count() == 0
    found = class_medians(df.withColumn("x", F.col("t") * 2), ["t", "x"], ["y"])
    assert found.filter("median <> (y + 3000) * if(column = 'x', 2, 1)").count() == 0 and found.count() == 6_000


def test_written_order(spark, tmp_path):
    df = spark.range(500).selectExpr("500 - id as t", "id % 7 as k")
    sorted_by_time(df, "t", ["k"], 5).write.parquet(str(tmp_path / "good"))
    good = order_inversions(spark.read.parquet(str(tmp_path / "good")), ["t", "k"]).first()
    assert (good.n_rows, good.n_files, good.inversions) == (500, 5, 0)
    df.repartitionByRange(5, F.col("t").desc()).sortWithinPartitions("t").write.parquet(str(tmp_path / "files"))
    assert order_inversions(spark.read.parquet(str(tmp_path / "files")), ["t"]).first().inversions == 4
    spark.range(10).selectExpr("if(id = 4, -1, id) as t").coalesce(1).write.parquet(str(tmp_path / "rows"))
    assert order_inversions(spark.read.parquet(str(tmp_path / "rows")), ["t"]).first().inversions == 1
    assert order_inversions(spark.read.parquet(str(tmp_path / "rows")).filter("t > 99"), ["t"]).first().inversions == 0
