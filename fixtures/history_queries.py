"""Labels, trailing windows, lags, recency, latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.registry import ORACLES, query
from fixtures.views import LABELS_SQL, labels, tx, tx_geo, with_tx
from tidemark.operators.entities import latest
from tidemark.operators.events import attach_labels
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import DEFAULT_POLICY, SkewPolicy
from tidemark.plans import silver
from tidemark.session import shared_dir
from tidemark.sources.lake import Lake

SPANS = {"10m": 600, "1h": 3600, "1d": 86_400, "7d": 604_800, "30d": 2_592_000}


def frame(key: str, span: str, prior: bool = False) -> str:
    end = "1 preceding" if prior else "current row"
    return f"over (partition by {key} order by ts_epoch range between {SPANS[span]} preceding and {end})"


def _columns(template: str, spans: list[str]) -> str:
    return ", ".join(template.format(span=s, w=frame("cc_num", s)) for s in spans)


CARD_SPANS = ["10m", "1h", "1d", "7d"]
MERCHANT_SPANS = ["1d", "7d", "30d"]
CARD_SQL = ", ".join(
    f"cast(sum(amount) {frame('cc_num', s)} as double) as cc_sum_amt_{s}, count(*) {frame('cc_num', s)} as cc_cnt_{s}"
    for s in CARD_SPANS
)
MERCHANT_SQL = ", ".join(
    f"cast(sum(label_is_fraud) {frame('merchant_id', s, prior=True)} as bigint) as m_fraud_cnt_{s}"
    for s in MERCHANT_SPANS
)
BY_CARD = "over (partition by cc_num order by ts_epoch, t_id)"
LAG_SQL = (
    f"lag(ts_epoch) {BY_CARD} as cc_prev_ts_epoch, lag(ip_address) {BY_CARD} as cc_prev_ip, "
    f"lag(card_present) {BY_CARD} as cc_prev_card_present, ts_epoch - lag(ts_epoch) {BY_CARD} as cc_time_since_last_s"
)
FEATURES_SQL = f"""
feat as (
  select t_id, ts, ts_epoch, cc_num, merchant_id, amount, ip_address, card_present, {CARD_SQL}, {LAG_SQL},
         {MERCHANT_SQL}, label_is_fraud
  from tx)"""
FEATURE_NAMES = ", ".join(silver.FEATURE_COLUMNS)


@query(
    "roll_sum",
    with_tx(
        "select t_id, "
        + _columns("cast(sum(amount) {w} as double) as cc_sum_amt_{span}", CARD_SPANS)
        + " from tx"
    ),
)
def roll_sum(spark, sf_dir, policy=DEFAULT_POLICY):
    specs = [Rolling(f"cc_sum_amt_{s}", SPANS[s], "amount") for s in CARD_SPANS]
    events = tx(spark, sf_dir).select("t_id", "cc_num", "ts_epoch", "amount")
    out = history(events, ["cc_num"], "ts_epoch", ["t_id"], specs, policy=policy)
    return out.select("t_id", *(s.name for s in specs))


# The other plans of the same operators, over the same tables: running totals, and keys cut into tiles.
RUNNING, TILED = SkewPolicy(frame_rows=0), SkewPolicy(frame_rows=0, tile_rows=20)


@query("roll_sum_running", ORACLES["roll_sum"])
def roll_sum_running(spark, sf_dir):
    return roll_sum(spark, sf_dir, RUNNING)


@query("roll_sum_tiled", ORACLES["roll_sum"])
def roll_sum_tiled(spark, sf_dir):
    return roll_sum(spark, sf_dir, TILED)


@query("roll_count", with_tx("select t_id, " + _columns("count(*) {w} as cc_cnt_{span}", CARD_SPANS) + " from tx"))
def roll_count(spark, sf_dir):
    specs = [Rolling(f"cc_cnt_{s}", SPANS[s]) for s in CARD_SPANS]
    events = tx(spark, sf_dir).select("t_id", "cc_num", "ts_epoch")
    out = history(events, ["cc_num"], "ts_epoch", ["t_id"], specs)
    return out.select("t_id", *(s.name for s in specs))


@query("roll_prior", with_tx(f"select t_id, {MERCHANT_SQL} from tx"))
def roll_prior(spark, sf_dir, policy=DEFAULT_POLICY):
    events = tx(spark, sf_dir).select("t_id", "merchant_id", "ts_epoch", "label_is_fraud")
    out = history(events, ["merchant_id"], "ts_epoch", ["t_id"], silver.MERCHANT_ROLLING, policy=policy)
    return out.select("t_id", *(s.name for s in silver.MERCHANT_ROLLING))


@query("roll_prior_tiled", ORACLES["roll_prior"])
def roll_prior_tiled(spark, sf_dir):
    return roll_prior(spark, sf_dir, TILED)


@query(
    "roll_prior_delayed",
    with_tx(
        f"""
        select t_id, m_known_fraud_1d, m_known_fraud_30d from (
          select t_id, is_tx,
                 cast(sum(label) {frame("merchant_id", "1d", True)} as bigint) as m_known_fraud_1d,
                 cast(sum(label) {frame("merchant_id", "30d", True)} as bigint) as m_known_fraud_30d
          from (select t_id, merchant_id, ts_epoch, 0 as label, true as is_tx from tx
                union all
                select t_id, merchant_id, cast(floor(epoch(label_available_ts)) as bigint), 1, false from lab))
        where is_tx
        """,
        LABELS_SQL,
    ),
)
def roll_prior_delayed(spark, sf_dir):
    return silver.known_fraud_counts(
        tx(spark, sf_dir), labels(spark, sf_dir), {"m_known_fraud_1d": 86_400, "m_known_fraud_30d": 2_592_000}
    )


@query(
    "lags",
    with_tx(
        f"select t_id, lag(ts_epoch) {BY_CARD} as cc_prev_ts_epoch, lag(ip_address) {BY_CARD} as cc_prev_ip, "
        f"lag(card_present) {BY_CARD} as cc_prev_card_present from tx"
    ),
)
def lags(spark, sf_dir, policy=DEFAULT_POLICY):
    events = tx_geo(spark, sf_dir).select("t_id", "cc_num", "ts_epoch", "ip_address", "card_present")
    out = history(events, ["cc_num"], "ts_epoch", ["t_id"], lags=silver.CARD_LAGS, policy=policy)
    return out.select("t_id", *(lag.name for lag in silver.CARD_LAGS))


@query("lags_tiled", ORACLES["lags"])
def lags_tiled(spark, sf_dir):
    return lags(spark, sf_dir, TILED)


@query("recency", with_tx(f"select t_id, ts_epoch - lag(ts_epoch) {BY_CARD} as cc_time_since_last_s from tx"))
def recency(spark, sf_dir):
    events = tx(spark, sf_dir).select("t_id", "cc_num", "ts_epoch")
    out = history(events, ["cc_num"], "ts_epoch", ["t_id"], lags=[Lag("prev")])
    return out.select("t_id", (F.col("ts_epoch") - F.col("prev")).alias("cc_time_since_last_s"))


@query("silver_features", with_tx(f"select {FEATURE_NAMES} from feat", FEATURES_SQL))
def silver_features(spark, sf_dir):
    return silver.transaction_features(tx_geo(spark, sf_dir).drop("label_is_fraud"), labels(spark, sf_dir))


@query(
    "label_join",
    with_tx(
        "select tx.t_id, cast(case when lab.t_id is null then 0 else 1 end as integer) as label_is_fraud "
        "from tx left join (select distinct t_id from lab) lab on lab.t_id = tx.t_id",
        LABELS_SQL,
    ),
)
def label_join(spark, sf_dir):
    events = tx(spark, sf_dir).select("t_id")
    known = labels(spark, sf_dir)
    return attach_labels(events, known.unionByName(known))


def card_states(spark, sf_dir):
    """Card features per event; they do not depend on labels."""
    events = tx_geo(spark, sf_dir).select("t_id", "ts", "ts_epoch", "cc_num", "amount", "ip_address", "card_present")
    return silver.card_features(events)


def merchant_states(spark, sf_dir):
    events = tx(spark, sf_dir).select("t_id", "ts", "ts_epoch", "merchant_id")
    return silver.merchant_features(attach_labels(events, labels(spark, sf_dir)))


def latest_sql(key: str, columns: str) -> str:
    return with_tx(
        f"select {columns} from (select *, row_number() over (partition by {key} order by ts desc, t_id desc) as rn "
        "from feat) where rn = 1",
        FEATURES_SQL,
    )


CARD_SNAPSHOT_COLUMNS = "cc_num, ts as event_ts, " + ", ".join(silver.CARD_SNAPSHOT_FEATURES)
MERCHANT_SNAPSHOT_COLUMNS = "merchant_id, ts as event_ts, " + ", ".join(silver.MERCHANT_SNAPSHOT_FEATURES)


@query("latest_card", latest_sql("cc_num", CARD_SNAPSHOT_COLUMNS))
def latest_card(spark, sf_dir):
    return silver.card_snapshot(card_states(spark, sf_dir))


@query("latest_merchant", latest_sql("merchant_id", MERCHANT_SNAPSHOT_COLUMNS))
def latest_merchant(spark, sf_dir):
    return silver.merchant_snapshot(merchant_states(spark, sf_dir))


@query(
    "latest_order",
    "select o_custkey, o_orderkey, o_orderdate, o_totalprice from (select *, row_number() over "
    "(partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1",
)
def latest_order(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    newest = latest(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("silver_by_day", with_tx(f"select {FEATURE_NAMES} from feat", FEATURES_SQL))
def silver_by_day(spark, sf_dir):
    """A first load of many days, a single day and the rest as runs of their own, each on the state before it."""
    lake = Lake(spark, shared_dir(spark, "lake"))
    day = F.date_format("ts", "yyyy-MM-dd")
    dated = F.when(day <= "2024-01-20", "2024-01-20").when(day == "2024-01-21", day).otherwise("2024-12-31")
    events = tx_geo(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    lake.publish_by_day(events.drop("label_is_fraud").withColumn("dt", dated), "bronze/transactions", "r1")
    when = events.select("t_id", dated.alias("dt"))
    lake.publish_by_day(labels(spark, sf_dir).join(when, "t_id"), "bronze/fraud_labels", "r1")
    for dt in ("2024-01-20", "2024-01-21", "2024-12-31"):
        silver.build(lake, dt, "r1")
    return lake.read_all("silver/tx_features").select(*silver.FEATURE_COLUMNS).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
