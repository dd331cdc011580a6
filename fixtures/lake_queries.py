"""Landing files, versioned datasets, manifest, scalar functions on raw text."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.history_queries import CARD_SNAPSHOT_COLUMNS, card_states, latest_sql
from fixtures.quality_queries import RAW_SQL, gate_inputs
from fixtures.registry import query
from fixtures.views import LABELS_SQL, labels, tx, tx_geo, with_tx
from tidemark.contracts import LABELS_RAW, TRANSACTIONS_RAW
from tidemark.functions.scalars import ipv4_number, ipv4_text, money
from tidemark.functions.times import iso_text, parse_ts
from tidemark.operators.events import order_inversions, run_id_of, sorted_by_time
from tidemark.operators.quality import GateError
from tidemark.plans import bronze, silver
from tidemark.session import shared_dir
from tidemark.sources.jsonl import read_jsonl, typed, write_jsonl
from tidemark.sources.lake import Lake, check_published, latest_versions, versions_of_run
from tidemark.streaming.incremental import dedupe_available


TEXT_COLUMNS = ["t_id", "cc_num", "account_id", "merchant_id", "country", "category"]


@query(
    "ingest_jsonl",
    with_tx(
        "select "
        + ", ".join(f"cast({c} as varchar) as {c}" for c in TEXT_COLUMNS)
        + ", amount, currency, ip_address, card_present, channel, lat, lon, date_trunc('second', ts) as ts from tx"
    ),
)
def ingest_jsonl(spark, sf_dir):
    path = shared_dir(spark, "landing")
    as_text = {c: F.col(c).cast("string") for c in TEXT_COLUMNS}
    raw = tx_geo(spark, sf_dir).withColumns({**as_text, "ts": iso_text(F.col("ts"))}).select(*TRANSACTIONS_RAW.names)
    write_jsonl(raw, path)
    rows = typed(read_jsonl(spark, path, TRANSACTIONS_RAW).rows)
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "roundtrip_json",
    "select doc_id, text, lang, source, n_chars from documents",
)
def roundtrip_json(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = shared_dir(spark, "json")
    write_jsonl(documents, path)
    return read_jsonl(spark, path, documents.schema).rows


@query(
    "ingest_gate",
    with_tx(
        "select 'transactions' as dataset, count(*) filter (t_id % 50 <> 0) as n_rows, count(*) filter (t_id % 50 = 0) as n_rejects, "
        "'transactions: ' || count(*) filter (t_id % 50 = 0) || ' unreadable lines' as gate from tx union all "
        "select 'fraud_labels', count(*), cast(0 as bigint), null from lab",
        LABELS_SQL,
    ),
)
def ingest_gate(spark, sf_dir):
    """A delivery in which some amounts are written as text: refused by the gate, and landed with rejects without it."""
    path = shared_dir(spark, "landing")
    as_text = {c: F.col(c).cast("string") for c in TEXT_COLUMNS}
    raw = tx_geo(spark, sf_dir).withColumns({**as_text, "ts": iso_text(F.col("ts"))}).select(*TRANSACTIONS_RAW.names)
    others = [c for c in raw.columns if c != "amount"]
    as_text_too = F.to_json(F.struct(*others, F.col("amount").cast("string").alias("amount")))
    raw.select(F.when(F.col("t_id") % 50 == 0, as_text_too).otherwise(F.to_json(F.struct(*raw.columns)))).write.text(f"{path}/tx")
    known = labels(spark, sf_dir).withColumns({"t_id": F.col("t_id").cast("string"), "cc_num": F.col("cc_num").cast("string"), "ts": iso_text(F.col("ts"))})
    write_jsonl(known.select(*LABELS_RAW.names), f"{path}/labels")
    landing = bronze.Landing(f"{path}/tx", f"{path}/labels", "", "", "")
    lake = Lake(spark, f"{path}/lake")
    verdict = None
    try:
        bronze.ingest(lake, landing, "2024-01-30", "gated")
    except GateError as error:
        verdict = str(error)
    bronze.ingest(lake, landing, "2024-01-30", "open", gate=False)
    parts = []
    for name, gate in (("transactions", verdict), ("fraud_labels", None)):
        n_rows = lake.read(f"bronze/{name}").agg(F.count(F.lit(1)).alias("n_rows"))
        n_rejects = lake.read(f"rejects/{name}").agg(F.count(F.lit(1)).alias("n_rejects"))
        columns = [F.lit(name).alias("dataset"), "n_rows", "n_rejects", F.lit(gate).cast("string").alias("gate")]
        parts.append(n_rows.join(n_rejects, F.lit(True)).select(*columns))
    return parts[0].unionByName(parts[1])


DAY_SQL = "strftime(ts, '%Y-%m-%d')"


@query(
    "publish_layout",
    with_tx(f"select {DAY_SQL} as dt, 'run_1' as run_id, count(*) as n, cast(sum(amount) as double) as amount from tx group by 1"),
)
def publish_layout(spark, sf_dir):
    lake = Lake(spark, shared_dir(spark, "lake"))
    days = tx(spark, sf_dir).withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    lake.publish_by_day(days, "bronze/transactions", "run:1")
    written = lake.read_all("bronze/transactions").groupBy(F.col("dt").cast("string").alias("dt"), "run_id")
    return written.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@query(
    "verify_published",
    with_tx(
        f"select {DAY_SQL} as dt, 'bronze/transactions/dt=' || {DAY_SQL} || '/run_id=run_1' as prefix, count(*) as n_rows, "
        "true as holds_data from tx group by 1"
    ),
)
def verify_published(spark, sf_dir):
    lake = Lake(spark, shared_dir(spark, "lake"))
    days = tx(spark, sf_dir).withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    lake.publish_by_day(days, "bronze/transactions", "run:1")
    data = lake.read_all("bronze/transactions").withColumn("dt", F.col("dt").cast("string"))
    return check_published(lake.manifest(), data).select("dt", "prefix", "n_rows", "holds_data")


@query("publish_current", latest_sql("cc_num", CARD_SNAPSHOT_COLUMNS))
def publish_current(spark, sf_dir):
    lake = Lake(spark, shared_dir(spark, "lake"))
    lake.publish(silver.card_snapshot(card_states(spark, sf_dir)), "silver/online/card_features", "2024-01-30", "r1")
    lake.publish_current("silver/online/card_features", "2024-01-30", "r1")
    return lake.read_current("silver/online/card_features")


# A manifest with one entry per event: the event type is the dataset, its day the date.
ENTRIES_SQL = f"""
entries as (select event_type as dataset, {DAY_SQL} as dt, 'run_' || cast(t_id as varchar) as run_id,
                   event_type || '/dt=' || {DAY_SQL} || '/run_id=run_' || cast(t_id as varchar) as prefix,
                   ts as published_at from tx)"""


def _entries(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    run = F.concat(F.lit("run_"), F.col("t_id").cast("string"))
    return tx(spark, sf_dir).select(
        F.col("event_type").alias("dataset"),
        day.alias("dt"),
        run.alias("run_id"),
        F.concat("event_type", F.lit("/dt="), day, F.lit("/run_id="), run).alias("prefix"),
        F.col("ts").alias("published_at"),
    )


@query(
    "manifest_latest",
    with_tx(
        "select dataset, dt, run_id, prefix, published_at from (select *, row_number() over (partition by dataset, dt "
        "order by published_at desc, run_id desc) as rn from entries) where rn = 1",
        ENTRIES_SQL,
    ),
)
def manifest_latest(spark, sf_dir):
    return latest_versions(_entries(spark, sf_dir))


@query("manifest_by_run", with_tx("select * from entries where run_id = 'run_77'", ENTRIES_SQL))
def manifest_by_run(spark, sf_dir):
    return versions_of_run(_entries(spark, sf_dir), "run_77")


@query(
    "run_id_extract",
    with_tx(
        "select t_id, case when event_type = 'error' then 'unknown_run' else 'run_' || cast(cc_num as varchar) end as run_id "
        "from tx"
    ),
)
def run_id_extract(spark, sf_dir):
    run = F.when(F.col("event_type") != "error", F.concat(F.lit("/run_id=run_"), F.col("cc_num").cast("string")))
    path = F.concat(F.lit("bronze/dt="), F.date_format("ts", "yyyy-MM-dd"), F.coalesce(run, F.lit("")), F.lit("/part-0"))
    return tx(spark, sf_dir).select("t_id", run_id_of(path).alias("run_id"))


@query("sorted_log", with_tx("select t_id, ts, cc_num, amount from tx"))
def sorted_log(spark, sf_dir):
    return sorted_by_time(tx(spark, sf_dir).select("t_id", "ts", "cc_num", "amount"), "ts", ["t_id"])


@query("sorted_log_order", with_tx("select count(*) as n_rows, cast(0 as bigint) as inversions from tx"))
def sorted_log_order(spark, sf_dir):
    """The written log, read back in the order of its files and rows."""
    path = shared_dir(spark, "log")
    sorted_by_time(tx(spark, sf_dir).select("t_id", "ts", "cc_num", "amount"), "ts", ["t_id"]).write.parquet(path)
    return order_inversions(spark.read.parquet(path), ["ts", "t_id"]).select("n_rows", "inversions")


@query("ts_parse", with_tx("select t_id, ts as raw, try_cast(ts as timestamp) as parsed from raw_tx", RAW_SQL))
def ts_parse(spark, sf_dir):
    raw = gate_inputs(spark, sf_dir).tx
    return raw.select("t_id", F.col("ts").alias("raw"), parse_ts(F.col("ts")).cast("timestamp_ntz").alias("parsed"))


@query("ts_format", with_tx("select t_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso from tx"))
def ts_format(spark, sf_dir):
    return tx(spark, sf_dir).select("t_id", iso_text(F.col("ts")).alias("iso"))


@query(
    "normalize_amount",
    "select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18,2)) as amount, "
    "round(l_discount, 6) as discount from lineitem",
)
def normalize_amount(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        money(F.col("l_extendedprice")).alias("amount"),
        F.round("l_discount", 6).alias("discount"),
    )


@query(
    "ip_number",
    with_tx(
        "select t_id, cast(split_part(ip_address, '.', 1) as bigint) * 16777216 + cast(split_part(ip_address, '.', 2) as bigint) "
        "* 65536 + cast(split_part(ip_address, '.', 3) as bigint) * 256 + cast(split_part(ip_address, '.', 4) as bigint) "
        "as number, ip_address as back from tx"
    ),
)
def ip_number(spark, sf_dir):
    number = ipv4_number(F.col("ip_address"))
    return tx_geo(spark, sf_dir).select("t_id", number.alias("number"), ipv4_text(number).alias("back"))


@query(
    "ingest_labels",
    with_tx(
        "select cast(t_id as varchar) as t_id, cast(cc_num as varchar) as cc_num, case when card_present then 'geo_fraud' "
        "else 'chain_attack' end as explanation, date_trunc('second', ts) as ts from tx where label_is_fraud = 1"
    ),
)
def ingest_labels(spark, sf_dir):
    path = shared_dir(spark, "landing")
    texts = {c: F.col(c).cast("string") for c in ("t_id", "cc_num")}
    raw = labels(spark, sf_dir).withColumns({**texts, "ts": iso_text(F.col("ts"))}).select(*LABELS_RAW.names)
    write_jsonl(raw, path)
    return typed(read_jsonl(spark, path, LABELS_RAW).rows).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_dedup", with_tx("select distinct t_id, cc_num, ts, amount from tx"))
def stream_dedup(spark, sf_dir):
    """The events in two deliveries, the second one a replay of all; the stream is stopped and started between them."""
    feed, target, checkpoint = (shared_dir(spark, name) for name in ("feed", "deduped", "checkpoint"))
    events = tx(spark, sf_dir).select("t_id", "cc_num", F.col("ts").cast("timestamp").alias("ts"), "amount")
    for delivery in (events.filter(F.pmod(F.xxhash64("t_id"), F.lit(3)) > 0), events):
        delivery.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        dedupe_available(stream, ["t_id"], "ts", "60 days", target, checkpoint).awaitTermination()
    return spark.read.schema(events.schema).parquet(target).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
