"""The bucketed online table."""

import glob
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators.entities import FeatureView, lookup
from tidemark.plans.online import OnlineTable
from tidemark.sources.lake import Lake, NotPublished

VIEW = FeatureView("v", ("k",), {"n": T.LongType()}, 3_600)


def at(second):
    return datetime(2026, 1, 1, 0, 0, second, tzinfo=timezone.utc)


def feed(spark, data):
    return spark.createDataFrame([(k, at(s), n) for k, s, n in data], "k string, event_ts timestamp, n int")


def now(table):
    return rows(table.read().select("k", "n"))


def test_runs_move_it_forward_and_leave_other_buckets_alone(spark, tmp_path):
    table = OnlineTable(Lake(spark, str(tmp_path / "lake")), VIEW, ("n",), buckets=16)
    with pytest.raises(NotPublished):
        table.read()
    keys = [chr(97 + i) for i in range(20)]
    data = [(k, 1 + i, i) for i, k in enumerate(keys)] + [("a", 1, -1), ("late", 0, 0)]
    head = table.advance(feed(spark, data), at(10), "r:1", at(1))
    assert now(table) == [(k, i) for i, k in enumerate(keys[:10])]
    assert head.run_id == "r_1" and table.head() == head
    # The next run sees b and new keys; the files of buckets it does not touch are not even opened.
    new = feed(spark, [*data, ("b", 12, 77), ("b", 12, 78), ("u", 15, 5), ("c", 3, 99)]).filter("k in ('b', 'u', 'c')")
    touched = {r[0] for r in spark.createDataFrame([("b",), ("u",)], "k string").select(table._bucket()).collect()}
    untouched = set(head.runs) - touched
    assert untouched and touched
    held = {}
    for bucket in untouched:
        for path in glob.glob(f"{table._root}/data/run_id=r_1/bucket={bucket}/*.parquet"):
            held[path] = open(path, "rb").read()
            with open(path, "wb") as f:
                f.write(b"not a table")
    second = table.advance(new, at(20), "r:2")
    for path, content in held.items():
        with open(path, "wb") as f:
            f.write(content)
    assert {b for b, run in second.runs.items() if run == "r_2"} == touched
    assert now(table) == sorted([(k, i) for i, k in enumerate(keys[:10]) if k != "b"] + [("b", 78), ("u", 5)])
    # Readers of the first run still find it whole.
    assert rows(table.read(head=head).select("k", "n")) == [(k, i) for i, k in enumerate(keys[:10])]
    few = table.read_keys(feed(spark, [("b", 1, 1)]))
    assert ("b", 78) in rows(few.select("k", "n")) and len(few.inputFiles()) == 1
    asked = spark.createDataFrame([("b",), ("zz",)], "k string")
    assert rows(lookup(asked, {"v": (VIEW, table.read_keys(asked))}, ["v:n"], F.lit(at(30)))) == [("b", 78), ("zz", None)]


def test_guards_and_empty_runs(spark, tmp_path):
    table = OnlineTable(Lake(spark, str(tmp_path / "lake")), VIEW, buckets=4)
    table.advance(feed(spark, []), at(5), "r1")
    assert now(table) == [] and table.head().watermark == at(5)
    table.advance(feed(spark, [("a", 5, 1), ("b", 6, 2)]), at(10), "r2")
    assert now(table) == [("b", 2)]  # a came behind the watermark
    table.advance(feed(spark, []), at(11), "r3")
    assert now(table) == [("b", 2)]
    with pytest.raises(ContractError, match="is at"):
        table.advance(feed(spark, []), at(11), "r4")
    with pytest.raises(ContractError, match="another run id"):
        table.advance(feed(spark, []), at(12), "r2")
    with pytest.raises(ContractError, match="time zone"):
        table.advance(feed(spark, []), datetime(2026, 1, 2), "r5")
    stale = table.head()
    table.advance(feed(spark, [("c", 13, 3)]), at(14), "r5")
    with pytest.raises(ContractError, match="meanwhile"):
        table._publish(stale, {}, "r6", at(20))
    assert now(table) == [("b", 2), ("c", 3)]
