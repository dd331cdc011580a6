"""Labelled point-in-time training sets, and the training run on top of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import parse_ts
from tidemark.operators.asof import FeatureTable, asof_join_all
from tidemark.operators.events import attach_labels
from tidemark.operators.model import TrainConfig, run_record, train
from tidemark.operators.tiles import DEFAULT_POLICY, SkewPolicy
from tidemark.plans import silver
from tidemark.sources.lake import Lake

# Base columns of the training set; the label's explanation stays out, it would leak.
BASE_COLUMNS = [
    "t_id", "event_ts", "cc_num", "merchant_id", "amount", "country", "category", "channel", "card_present",
    "label_is_fraud",
]
# Output columns of the features. Those of merchants say so already.
CARD_NAMES = {c: f"card_{c}" for c in silver.CARD_SNAPSHOT_FEATURES}
MERCHANT_NAMES = {c: c for c in silver.MERCHANT_SNAPSHOT_FEATURES}


def training_set(
    tx: DataFrame,
    labels: DataFrame,
    card: DataFrame,
    merchant: DataFrame,
    tie: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Each transaction with its label and the newest card and merchant features not in its future.

    ``card`` and ``merchant`` are feature histories (or latest-only snapshots) with ``event_ts``; ``tie``
    names their id columns for states of one instant.
    """
    event_ts = parse_ts(F.col("ts")) if dict(tx.dtypes)["ts"] == "string" else F.col("ts")
    base = attach_labels(tx.drop("label_is_fraud"), labels).withColumn("event_ts", event_ts).select(*BASE_COLUMNS)
    tables = [
        FeatureTable(df.select(key, "event_ts", *tie, *names), (key,), "event_ts", names, tuple(tie))
        for df, key, names in ((card, "cc_num", CARD_NAMES), (merchant, "merchant_id", MERCHANT_NAMES))
    ]
    out = asof_join_all(base, tables, "event_ts", policy)
    return out.select(*BASE_COLUMNS, *CARD_NAMES.values(), *MERCHANT_NAMES.values())


def build(
    lake: Lake, dt: str, run_id: str, snapshots: bool = False, policy: SkewPolicy = DEFAULT_POLICY
) -> str:
    """Publish the training set of one date, from feature histories or from the current snapshots."""
    tx, labels = lake.read("bronze/transactions", dt), lake.read("bronze/fraud_labels", dt)
    if snapshots:
        card = lake.read_current("silver/online/card_features")
        merchant = lake.read_current("silver/online/merchant_features")
        df = training_set(tx, labels, card, merchant, policy=policy)
    else:
        features = lake.read("silver/tx_features", dt)
        card, merchant = silver.card_history(features), silver.merchant_history(features)
        df = training_set(tx, labels, card, merchant, ("t_id",), policy)
    return lake.publish(df, "silver/training_set", dt, run_id)


def train_run(lake: Lake, dt: str, run_id: str, cfg: TrainConfig = TrainConfig(), name: str = "baseline") -> str:
    """Train on the published set of one date; save the model, append the run record; returns the model prefix."""
    df = lake.read("silver/training_set", dt)
    trained = train(df, cfg)
    prefix = lake.save_model(trained.model, name, dt, run_id)
    lake.publish(run_record(df, trained, cfg, run_id), "runs", dt, run_id)
    return prefix
