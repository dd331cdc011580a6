from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.contracts import ContractError, TRANSACTIONS_RAW
from tidemark.operators.events import run_id_of
from tidemark.session import shared_dir
from tidemark.sources.jsonl import read_jsonl, typed, write_jsonl
from tidemark.sources.lake import Lake, NotPublished, check_published, latest_versions
from tidemark.sources.paths import hadoop_uri, read_parquet, write_parquet

LINES = """
{"t_id": "1", "amount": 5, "ts": "2026-01-01T00:00:00Z", "country": "SE"}

{"t_id": "2", "amount": 5.25, "ts": "2026-01-01T00:00:00"}
{"t_id": "3", "amount": 1, "ts": "yesterday"}
{"t_id": "4", "amount": "much"}
not json
{"t_id": "5", "amount": 0.1, "ts": "2026-01-01T02:00:00+02:00", "extra": 1, "country": "é"}
"""


def test_jsonl_contract(spark, tmp_path):
    path = tmp_path / "tx.jsonl"
    path.write_text(LINES, encoding="utf-8")
    landed = read_jsonl(spark, str(path), TRANSACTIONS_RAW)
    assert landed.rows.schema == TRANSACTIONS_RAW
    got = {r.t_id: r for r in typed(landed.rows).collect()}
    assert set(got) == {"1", "2", "3", "5"}
    assert str(got["1"].amount) == "5.00" and str(got["2"].amount) == "5.25"
    assert got["3"].ts is None and got["5"].ts == got["1"].ts and got["5"].country == "é"
    bad = [r.line for r in landed.rejects.collect()]
    assert sorted(bad) == ["not json", '{"t_id": "4", "amount": "much"}']
    assert landed.rows.count() == 4


def test_jsonl_round_trip_keeps_text_as_is(spark, tmp_path):
    df = spark.createDataFrame([("ü \"x\"", 1), (None, 2)], "a string, b int")
    path = str(tmp_path / "out")
    write_jsonl(df, path)
    assert rows(read_jsonl(spark, path, df.schema).rows) == rows(df)
    assert "ü" in spark.read.text(path).filter("value like '%x%'").first().value


def test_paths(spark, tmp_path):
    assert hadoop_uri("s3://b/k") == "s3a://b/k" and hadoop_uri("/a") == "/a"
    for part in ("a", "b"):
        write_parquet(spark.range(3), str(tmp_path / "current" / part))
    assert read_parquet(spark, str(tmp_path / "current" / "*" / "*.parquet")).count() == 6
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_run_id_of_path(spark):
    df = spark.createDataFrame([("a/run_id=r1/p",), ("a/b",)], "p string")
    assert rows(df.select(run_id_of(F.col("p")))) == [("r1",), ("unknown_run",)]


def test_publish_resolve_verify(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(NotPublished):
        lake.resolve("bronze/tx")
    lake.publish(spark.range(3), "bronze/tx", "2026-01-01", "manual:1")
    lake.publish(spark.range(5), "bronze/tx", "2026-01-01", "manual:2")
    lake.publish(spark.range(7), "bronze/tx", "2026-01-02", "manual:3")
    assert lake.resolve("bronze/tx", "2026-01-01") == "bronze/tx/dt=2026-01-01/run_id=manual_2"
    assert lake.read("bronze/tx").count() == 7
    assert lake.read("bronze/tx", "2026-01-01", "manual:1").count() == 3
    assert lake.read_all("bronze/tx").filter("run_id = 'manual_3'").count() == 7
    assert lake.verify("bronze/tx", "2026-01-02", "manual:3", spark.range(1).schema) == 7
    with pytest.raises(NotPublished, match="schema"):
        lake.verify("bronze/tx", "2026-01-02", "manual:3", TRANSACTIONS_RAW)
    with pytest.raises(NotPublished):
        lake.resolve("bronze/tx", "2026-01-03")
    lake.publish(spark.range(0), "bronze/tx", "2026-01-04", "r")
    with pytest.raises(NotPublished, match="no rows"):
        lake.verify("bronze/tx", "2026-01-04", "r")
    checked = check_published(lake.manifest(), lake.read_all("bronze/tx").withColumn("dt", F.col("dt").cast("string")))
    assert {r.run_id: (r.n_rows, r.holds_data) for r in checked.collect()}["r"] == (0, False)
    lake.publish_current("bronze/tx", "2026-01-02", "manual:3")
    lake.publish_current("bronze/tx", "2026-01-01", "manual:2")
    assert lake.read_current("bronze/tx").count() == 5
    assert lake.resolve("bronze/tx", kinds=["current"]) == "current/bronze/tx"


def test_empty_prefix_is_no_version(spark):
    t = [datetime(2026, 1, d, tzinfo=timezone.utc) for d in (1, 2)]
    entries = spark.createDataFrame(
        [("d", "1", "a", "p/a", t[0]), ("d", "1", "b", " \n", t[1]), ("e", "1", "b", "", t[0])],
        "dataset string, dt string, run_id string, prefix string, published_at timestamp",
    )
    assert [r.prefix for r in latest_versions(entries).collect()] == ["p/a"]


def test_days_are_written_in_one_job(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = spark.range(10).withColumn("dt", F.when(F.col("id") < 4, "2026-01-01").otherwise("2026-01-02"))
    lake.publish_by_day(df, "bronze/tx", "r1")
    assert lake.manifest().count() == 2
    assert lake.read("bronze/tx", "2026-01-01").count() == 4
    lake.publish_by_day(df.filter("id >= 4"), "bronze/tx", "r2")
    assert lake.read("bronze/tx", "2026-01-01").count() == 4
    assert lake.resolve("bronze/tx", "2026-01-02").endswith("run_id=r2")


def test_listed_versions_are_not_written_over(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.publish(spark.range(3), "d", "2026-01-01", "r1")
    with pytest.raises(ContractError, match="already"):
        lake.publish(spark.range(4), "d", "2026-01-01", "r1")
    days = spark.createDataFrame([(1, "2026-01-01"), (2, None)], "id int, dt string")
    with pytest.raises(ContractError, match="without dt"):
        lake.publish_by_day(days, "e", "r1")
    assert lake.manifest().count() == 1
    lake.publish_by_day(days.limit(1), "e", "r2")
    with pytest.raises(ContractError, match="already"):
        lake.publish_by_day(days.limit(1), "e", "r2")
