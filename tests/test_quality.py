import pytest

from tests.conftest import rows
from tidemark.contracts import LABELS_RAW, TRANSACTIONS_RAW, ContractError
from tidemark.operators import quality

Z = "2026-01-01T00:00:10Z"


def inputs(spark, tx=(), labels=()):
    base = dict(
        t_id="1", cc_num="c1", account_id="a1", merchant_id="m1", amount=5.0, currency="USD", country="SE",
        ip_address="1.2.3.4", card_present=True, channel="pos", category="fuel", lat=1.0, lon=1.0, ts=Z,
    )
    plain = ", ".join(
        f"{f.name} {'double' if f.name == 'amount' else f.dataType.simpleString()}" for f in TRANSACTIONS_RAW
    )
    raw = spark.createDataFrame([tuple({**base, **t}[n] for n in TRANSACTIONS_RAW.names) for t in tx], plain)
    raw = raw.withColumn("amount", raw.amount.cast("decimal(18,2)"))
    label = dict(t_id="1", cc_num="c1", explanation="geo_fraud", ts=Z)
    lab = spark.createDataFrame([tuple({**label, **x}[n] for n in LABELS_RAW.names) for x in labels], LABELS_RAW)
    keys = [spark.createDataFrame([(v,)], f"{k} string") for k, v in (("cc_num", "c1"), ("account_id", "a1"), ("merchant_id", "m1"))]
    return quality.GateInputs(raw, lab, *keys)


def test_clean_tables_pass(spark):
    found = quality.violations(inputs(spark, [{}, {"t_id": "2"}], [{}]))
    assert found.count() == 0
    quality.raise_if_any(found)


def test_each_rule_fires(spark):
    tx = [
        {"t_id": "null", "currency": None, "lat": None},
        {"t_id": "neg", "amount": -0.01},
        {"t_id": "pole", "lat": 90.5},
        {"t_id": "card", "cc_num": "cX"},
        {"t_id": "acct", "account_id": "aX"},
        {"t_id": "mer", "merchant_id": "mX"},
        {"t_id": "bad", "ts": "soon"},
        {"t_id": "naive", "ts": "2026-01-01T00:00:10"},
        {"t_id": "offset", "ts": "2026-01-01T01:00:10+01:00"},
        {"t_id": "twice"},
        {"t_id": "twice"},
    ]
    labels = [
        {"t_id": "null", "explanation": None},
        {"t_id": "ghost"},
        {"t_id": "card", "cc_num": "c1"},
        {"t_id": "neg", "cc_num": "cX"},
        {"t_id": "mer", "ts": "2026-01-01T00:00:09Z"},
        {"t_id": "acct", "ts": "soon"},
        {"t_id": "pole", "ts": "2026-01-01T00:00:11"},
        {"t_id": "offset"},
        {"t_id": "offset"},
    ]
    found = quality.violations(inputs(spark, tx, labels))
    assert {(r[0], r[1]) for r in rows(found)} == {
        ("tx_required", "null"),
        ("tx_amount", "neg"),
        ("tx_position", "pole"),
        ("tx_card", "card"),
        ("tx_account", "acct"),
        ("tx_merchant", "mer"),
        ("tx_ts_unreadable", "bad"),
        ("tx_ts_naive", "naive"),
        ("tx_duplicate", "twice"),
        ("label_required", "null"),
        ("label_unknown_tx", "ghost"),
        ("label_card_differs", "card"),
        ("label_card_differs", "neg"),
        ("label_card", "neg"),
        ("label_before_tx", "mer"),
        ("label_ts_unreadable", "acct"),
        ("label_ts_naive", "pole"),
        ("label_duplicate", "offset"),
    }
    assert {r.detail for r in found.filter("rule = 'tx_required'").collect()} == {"currency,lat"}
    with pytest.raises(quality.GateError, match="tx_amount: 1"):
        quality.raise_if_any(found)


def test_a_repeated_event_does_not_repeat_label_violations(spark):
    found = quality.label_violations(inputs(spark, [{}, {}], [{"cc_num": "cX"}]))
    assert sorted(r.rule for r in found.collect()) == ["label_card", "label_card_differs"]


def test_lacking_columns_raise(spark):
    bad = inputs(spark, [{}])
    with pytest.raises(ContractError, match="ip_address"):
        quality.transaction_violations(quality.GateInputs(bad.tx.drop("ip_address"), bad.labels, bad.cards, bad.accounts, bad.merchants))


def test_channels(spark):
    tx = [
        {"t_id": "1", "category": "ecommerce", "channel": "online", "card_present": False},
        {"t_id": "2", "category": "ecommerce"},
        {"t_id": "3", "category": "fuel", "channel": "online", "card_present": False},
        {"t_id": "4", "category": "travel", "channel": "online", "card_present": False},
        {"t_id": "5", "category": "travel", "channel": "online", "card_present": True},
    ]
    found = quality.channel_conflicts(inputs(spark, tx).tx, quality.ONLINE_ONLY, quality.TERMINAL_ONLY)
    assert sorted(r.t_id for r in found.collect()) == ["2", "3", "5"]
