import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.contracts import LABELS, LABELS_RAW
from tidemark.operators.entities import FeatureView
from tidemark.streaming.incremental import ingest_available, materialize_available, online_version


def test_only_new_files_are_ingested(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    paths = [str(tmp_path / n) for n in ("bronze", "rejects", "checkpoint")]

    def land(name, *lines):
        (landing / name).write_text("\n".join(lines))
        ingest_available(spark, str(landing), LABELS_RAW, *paths).awaitTermination()

    line = json.dumps({"t_id": "1", "cc_num": "c", "explanation": "geo_fraud", "ts": "2026-01-01T00:00:00Z"})
    land("a.jsonl", line, "", "broken")
    land("b.jsonl", line.replace('"1"', '"2"'))
    got = spark.read.parquet(paths[0]).drop("batch")
    assert got.schema == LABELS and sorted(r.t_id for r in got.collect()) == ["1", "2"]
    assert [r.line for r in spark.read.parquet(paths[1]).collect()] == ["broken"]


def test_online_table_moves_forward(spark, tmp_path):
    view = FeatureView("v", ("k",), {"n": T.LongType()}, 60)
    feed, online, checkpoint = (str(tmp_path / n) for n in ("feed", "online", "checkpoint"))
    schema = "k string, event_ts timestamp_ntz, n int"

    def push(*new):
        data = [(k, datetime(2026, 1, 1, 0, 0, s), n) for k, s, n in new]
        spark.createDataFrame(data, schema).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        materialize_available(stream, view, online, checkpoint).awaitTermination()
        return rows(online_version(spark, online).select("k", F.col("n")))

    assert push(("a", 1, 1), ("a", 5, 2), ("b", 3, 3)) == [("a", 2), ("b", 3)]
    assert push(("a", 4, 9), ("b", 7, 4), ("c", 1, 5)) == [("a", 2), ("b", 4), ("c", 5)]
    checkpoint = str(tmp_path / "another")  # batch ids start anew
    assert push(("a", 9, 7)) == [("a", 7), ("b", 4), ("c", 5)]
