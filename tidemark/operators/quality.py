"""The data-quality gate between landing and publishing.

Violations are rows ``(rule, key, detail)``. Row rules share one pass over the events, each reference
check being a left join to the distinct keys of its dimension; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import LABELS_RAW, TRANSACTIONS_RAW, require
from tidemark.functions.times import has_offset, parse_ts
from tidemark.operators.events import in_bounds
from tidemark.operators.profile import duplicate_keys


@dataclass(frozen=True)
class GateInputs:
    """Raw events and labels (``ts`` still text) and the known entities."""

    tx: DataFrame
    labels: DataFrame
    cards: DataFrame
    accounts: DataFrame
    merchants: DataFrame


class GateError(RuntimeError):
    """Some rule was violated; the message lists rules and counts."""


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _broken(key: Column, rules: dict[str, tuple[Column, Column]]) -> Column:
    """Array of violations of one row, ``rules`` being name -> (is broken, detail)."""
    found = [
        F.when(broken, F.struct(F.lit(rule).alias("rule"), key.alias("key"), _text(detail).alias("detail")))
        for rule, (broken, detail) in rules.items()
    ]
    return F.array_compact(F.array(*found))


def _listed(df: DataFrame, violations: Column) -> DataFrame:
    return df.select(F.explode(violations).alias("v")).select("v.*")


def _missing(columns: list[str]) -> tuple[Column, Column]:
    absent = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(columns))))
    return F.size(absent) > 0, F.array_join(absent, ",")


def _flag(df: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    known = dimension.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(known, key, "left")


def _unknown(key: str, flag: str) -> tuple[Column, Column]:
    return F.col(key).isNotNull() & F.col(flag).isNull(), F.col(key)


def _time_rules(prefix: str, ts: str = "ts") -> dict[str, tuple[Column, Column]]:
    text, parsed = F.col(ts), parse_ts(F.col(ts))
    return {
        f"{prefix}_ts_unreadable": (text.isNotNull() & parsed.isNull(), text),
        f"{prefix}_ts_naive": (parsed.isNotNull() & ~has_offset(text), text),
    }


def transaction_violations(inputs: GateInputs) -> DataFrame:
    tx = require(inputs.tx, TRANSACTIONS_RAW.names, "transactions")
    off_map = ~(in_bounds(F.col("lat"), -90, 90) & in_bounds(F.col("lon"), -180, 180))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    own_rules = {
        "tx_required": _missing(TRANSACTIONS_RAW.names),
        "tx_amount": (F.col("amount") < 0, F.col("amount")),
        "tx_position": (located & off_map, F.concat_ws(",", F.col("lat").cast("long"), F.col("lon").cast("long"))),
        **_time_rules("tx"),
    }
    references = {
        "tx_card": _unknown("cc_num", "__card"),
        "tx_account": _unknown("account_id", "__account"),
        "tx_merchant": _unknown("merchant_id", "__merchant"),
    }
    # Rules on the row itself come first: should a reference join shuffle, it moves ids only.
    tx = tx.select("t_id", "cc_num", "account_id", "merchant_id", _broken(_text("t_id"), own_rules).alias("__own"))
    tx = _flag(tx, inputs.cards, "cc_num", "__card")
    tx = _flag(tx, inputs.accounts, "account_id", "__account")
    tx = _flag(tx, inputs.merchants, "merchant_id", "__merchant")
    return _listed(tx, F.concat("__own", _broken(_text("t_id"), references)))


def label_violations(inputs: GateInputs) -> DataFrame:
    labels = require(inputs.labels, LABELS_RAW.names, "labels")
    ids = labels.select("t_id").distinct()
    # Only the labelled events are looked at, one row per id.
    labelled = (
        inputs.tx.join(ids, "t_id", "left_semi")
        .groupBy("t_id")
        .agg(F.max("cc_num").alias("__tx_cc"), F.max(parse_ts(F.col("ts"))).alias("__tx_ts"), F.lit(True).alias("__tx"))
    )
    labels = _flag(labels.join(labelled, "t_id", "left"), inputs.cards, "cc_num", "__card")
    rules = {
        "label_required": _missing(LABELS_RAW.names),
        "label_unknown_tx": _unknown("t_id", "__tx"),
        "label_card_differs": (F.col("cc_num") != F.col("__tx_cc"), F.col("cc_num")),
        "label_card": _unknown("cc_num", "__card"),
        "label_before_tx": (parse_ts(F.col("ts")) < F.col("__tx_ts"), F.col("ts")),
        **_time_rules("label"),
    }
    return _listed(labels, _broken(_text("t_id"), rules))


def duplicate_violations(df: DataFrame, rule: str, key: str = "t_id") -> DataFrame:
    repeated = duplicate_keys(df.filter(F.col(key).isNotNull()), [key])
    return repeated.select(F.lit(rule).alias("rule"), _text(key).alias("key"), _text("n").alias("detail"))


def violations(inputs: GateInputs) -> DataFrame:
    parts = [
        transaction_violations(inputs),
        duplicate_violations(inputs.tx, "tx_duplicate"),
        label_violations(inputs),
        duplicate_violations(inputs.labels, "label_duplicate"),
    ]
    return reduce(DataFrame.unionByName, parts)


def summarize(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n_violations")).orderBy("rule")


def counts(inputs: GateInputs) -> DataFrame:
    """n_tx, n_tx_ids and n_labels of the inputs, one row."""
    tx = inputs.tx.agg(F.count(F.lit(1)).alias("n_tx"), F.count_distinct("t_id").alias("n_tx_ids"))
    labels = inputs.labels.agg(F.count(F.lit(1)).alias("n_labels"))
    return tx.withColumn("__one", F.lit(1)).join(labels.withColumn("__one", F.lit(1)), "__one").drop("__one")


def raise_if_any(found: DataFrame) -> None:
    """Fail when a rule is violated. Only the per-rule counts reach the driver."""
    rows = summarize(found).collect()
    if rows:
        raise GateError("; ".join(f"{r.rule}: {r.n_violations}" for r in rows))


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key the dimension lacks."""
    known = dimension.select(key).distinct()
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def channel_conflicts(tx: DataFrame, online_only: str, present_only: list[str]) -> DataFrame:
    """Events whose channel or card presence cannot go with their category."""
    online = (F.col("channel") == "online") & ~F.col("card_present")
    at_terminal = (F.col("channel") == "pos") & F.col("card_present")
    category = F.col("category")
    broken = (
        F.when(category == online_only, ~online)
        .when(category.isin(present_only), ~at_terminal)
        .otherwise(~(online | at_terminal))
    )
    return tx.filter(broken)


# Categories sold online only, and at a terminal only. All others may be either.
ONLINE_ONLY = "ecommerce"
TERMINAL_ONLY = ["fuel", "grocery", "restaurant", "pharmacy"]
