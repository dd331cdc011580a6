"""Per-transaction features and entity snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import require
from tidemark.functions.times import epoch_seconds
from tidemark.operators.entities import latest
from tidemark.operators.events import attach_labels, normalize
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import DEFAULT_POLICY, KeyLoad, SkewPolicy, measure
from tidemark.plans import daily
from tidemark.sources.lake import Lake

# Look-back lengths in seconds and the column names the trained models expect.
CARD_SPANS = {"10m": 600, "1h": 3_600, "1d": 86_400, "7d": 604_800}
MERCHANT_SPANS = {"1d": 86_400, "7d": 604_800, "30d": 2_592_000}

CARD_ROLLING = [
    spec
    for span, seconds in CARD_SPANS.items()
    for spec in (Rolling(f"cc_sum_amt_{span}", seconds, "amount"), Rolling(f"cc_cnt_{span}", seconds))
]
CARD_LAGS = [
    Lag("cc_prev_ts_epoch"),
    Lag("cc_prev_ip", "ip_address"),
    Lag("cc_prev_card_present", "card_present"),
]
# Fraud before the event's second: its own label must not be among its features.
MERCHANT_ROLLING = [
    Rolling(f"m_fraud_cnt_{span}", seconds, "label_is_fraud", prior=True) for span, seconds in MERCHANT_SPANS.items()
]
CARD_STATE = daily.KeyState("card", "cc_num", tuple(CARD_ROLLING), tuple(CARD_LAGS))
MERCHANT_STATE = daily.KeyState("merchant", "merchant_id", tuple(MERCHANT_ROLLING))
CARD_SNAPSHOT_FEATURES = [*(s.name for s in CARD_ROLLING), "cc_time_since_last_s"]
MERCHANT_SNAPSHOT_FEATURES = [s.name for s in MERCHANT_ROLLING]
FEATURE_COLUMNS = [
    "t_id", "ts", "cc_num", "merchant_id", "amount", "ip_address", "card_present",
    *(s.name for s in CARD_ROLLING),
    *(lag.name for lag in CARD_LAGS), "cc_time_since_last_s",
    *MERCHANT_SNAPSHOT_FEATURES,
    "label_is_fraud",
]


def card_features(
    tx: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, load: KeyLoad | None = None
) -> DataFrame:
    """Sums, counts, lags and recency per card: one exchange for all of them."""
    out = history(tx, ["cc_num"], "ts_epoch", ["t_id"], CARD_ROLLING, CARD_LAGS, policy, load)
    return out.withColumn("cc_time_since_last_s", F.col("ts_epoch") - F.col("cc_prev_ts_epoch"))


def merchant_features(
    tx: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, load: KeyLoad | None = None
) -> DataFrame:
    """Prior fraud counts per merchant."""
    return history(tx, ["merchant_id"], "ts_epoch", ["t_id"], MERCHANT_ROLLING, policy=policy, load=load)


def known_fraud_counts(
    tx: DataFrame, labels: DataFrame, windows: dict[str, int], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """(t_id, counts): fraud per merchant counted from when its label became available, not from the event."""
    key = ["merchant_id"]
    events = tx.select("t_id", *key, "ts_epoch", F.lit(0).alias("known"), F.lit(True).alias("__is_tx"))
    arrivals = labels.select(
        "t_id",
        *key,
        epoch_seconds(F.col("label_available_ts")).alias("ts_epoch"),
        F.lit(1).alias("known"),
        F.lit(False).alias("__is_tx"),
    )
    specs = [Rolling(name, seconds, "known", prior=True) for name, seconds in windows.items()]
    both = history(events.unionByName(arrivals), key, "ts_epoch", ["t_id", "__is_tx"], specs, policy=policy)
    return both.filter("__is_tx").select("t_id", *windows)


def _narrow(tx: DataFrame) -> DataFrame:
    tx = tx if "ts_epoch" in tx.columns else normalize(tx)
    return tx.select("t_id", "ts", "ts_epoch", "cc_num", "merchant_id", "amount", "ip_address", "card_present")


def transaction_features(
    tx: DataFrame, labels: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row per transaction with all features and the label."""
    require(tx, ["t_id", "ts", "cc_num", "merchant_id", "amount", "ip_address", "card_present"], "transactions")
    narrow = _narrow(tx)
    # Keys are measured on the plain events: the label join and the features keep every row once.
    seconds = F.col("ts_epoch")
    card = measure(narrow, ["cc_num"], seconds, policy, max(CARD_SPANS.values()))
    merchant = measure(narrow, ["merchant_id"], seconds, policy, max(MERCHANT_SPANS.values()))
    with_card = card_features(attach_labels(narrow, labels), policy, card)
    return merchant_features(with_card, policy, merchant).select(*FEATURE_COLUMNS)


def features_of_day(lake: Lake, dt: str, tx: DataFrame, labels: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """:func:`transaction_features` of one date's events, their windows and lags reaching back over the dates before."""
    require(tx, ["t_id", "ts", "cc_num", "merchant_id", "amount", "ip_address", "card_present"], "transactions")
    narrow = _narrow(tx)
    labelled = attach_labels(narrow, labels)
    card, merchant = (daily.past_rows(lake, state, dt, labelled) for state in (CARD_STATE, MERCHANT_STATE))
    card_load, merchant_load = daily.load_of(narrow, card, CARD_STATE, policy), daily.load_of(narrow, merchant, MERCHANT_STATE, policy)
    out = daily.with_history(labelled, card, CARD_STATE, policy, card_load)
    out = out.withColumn("cc_time_since_last_s", F.col("ts_epoch") - F.col("cc_prev_ts_epoch"))
    return daily.with_history(out, merchant, MERCHANT_STATE, policy, merchant_load).select(*FEATURE_COLUMNS)


def card_snapshot(features: DataFrame) -> DataFrame:
    newest = latest(features, ["cc_num"], "ts", ["t_id"])
    return newest.select("cc_num", F.col("ts").alias("event_ts"), *CARD_SNAPSHOT_FEATURES)


def merchant_snapshot(features: DataFrame) -> DataFrame:
    newest = latest(features, ["merchant_id"], "ts", ["t_id"])
    return newest.select("merchant_id", F.col("ts").alias("event_ts"), *MERCHANT_SNAPSHOT_FEATURES)


def card_history(features: DataFrame) -> DataFrame:
    """Every state of every card: the right side of a point-in-time join."""
    return features.select("cc_num", F.col("ts").alias("event_ts"), "t_id", *CARD_SNAPSHOT_FEATURES)


def merchant_history(features: DataFrame) -> DataFrame:
    return features.select("merchant_id", F.col("ts").alias("event_ts"), "t_id", *MERCHANT_SNAPSHOT_FEATURES)


def build(lake: Lake, dt: str, run_id: str, policy: SkewPolicy = DEFAULT_POLICY) -> dict[str, str]:
    """Bronze to silver for one date, on top of the state that earlier dates have left. The wide table is computed and
    written once; both snapshots and the state for later dates are derived from what was written."""
    tx, labels = lake.read("bronze/transactions", dt), lake.read("bronze/fraud_labels", dt)
    wide = features_of_day(lake, dt, tx, labels, policy)
    out = {"features": lake.publish(wide, "silver/tx_features", dt, run_id)}
    features = lake.read("silver/tx_features", dt, run_id)
    timed = features.withColumn("ts_epoch", epoch_seconds(F.col("ts")))
    out.update(daily.publish_state(lake, dt, run_id, timed, [CARD_STATE, MERCHANT_STATE]))
    for name, snapshot in (("card_features", card_snapshot), ("merchant_features", merchant_snapshot)):
        dataset = f"silver/online/{name}"
        out[name] = lake.publish(snapshot(features), dataset, dt, run_id)
        lake.publish_current(dataset, dt, run_id)
    return out
