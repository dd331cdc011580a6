"""Feature views: materialization, incremental materialization, keyed lookup."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from fixtures.history_queries import FEATURES_SQL, card_states, merchant_states
from fixtures.registry import query
from fixtures.views import ntz, tx, with_tx
from tidemark.operators.entities import (
    DAY,
    card_view,
    lookup,
    materialize,
    materialize_increment,
    merchant_view,
    missing_values,
)
from tidemark.plans import silver
from tidemark.plans.online import OnlineTable
from tidemark.session import shared_dir
from tidemark.sources.lake import Lake

START, MIDDLE, END = "2024-01-05 00:00:00", "2024-01-12 00:00:00", "2024-01-20 23:59:59"
AS_OF = "2024-01-31 00:00:00"
# A day and an hour, so that part of the keys of the one-month test data has expired.
CARD, MERCHANT = replace(card_view(), ttl_seconds=DAY), replace(merchant_view(), ttl_seconds=6 * 3_600)
REFERENCES = [
    "card_txn_features:cc_cnt_10m",
    "card_txn_features:cc_sum_amt_10m",
    "card_txn_features:cc_cnt_1h",
    "merchant_risk_features:m_fraud_cnt_7d",
]
NAMES = [r.partition(":")[2] for r in REFERENCES]

CARD_TYPED = ", ".join(
    f"cast({name} as {'real' if 'sum' in name else 'bigint'}) as {name}" for name in silver.CARD_SNAPSHOT_FEATURES
)
WINDOW_SQL = with_tx(
    f"select cc_num, ts as event_ts, {CARD_TYPED} from (select *, row_number() over (partition by cc_num "
    f"order by ts desc, t_id desc) as rn from feat where ts between timestamp '{START}' and timestamp '{END}') "
    "where rn = 1",
    FEATURES_SQL,
)


def _card_states(spark, sf_dir):
    return silver.card_history(card_states(spark, sf_dir))


@query("materialize_window", WINDOW_SQL)
def materialize_window(spark, sf_dir):
    return materialize(_card_states(spark, sf_dir), CARD, ntz(START), ntz(END), ["t_id"])


@query("materialize_incr", WINDOW_SQL)
def materialize_incr(spark, sf_dir):
    states = _card_states(spark, sf_dir)
    online = materialize(states, CARD, ntz(START), ntz(MIDDLE), ["t_id"])
    return materialize_increment(online, states, CARD, ntz(MIDDLE), ntz(END), ["t_id"])


@query("materialize_job", WINDOW_SQL)
def materialize_job(spark, sf_dir):
    """Two stored runs over published states: the second reads the watermark and rewrites the buckets with new keys."""
    lake = Lake(spark, shared_dir(spark, "lake"))
    lake.publish(_card_states(spark, sf_dir), "silver/card_states", "2024-01-20", "r1")
    states = lake.read("silver/card_states")
    table = OnlineTable(lake, CARD, ("t_id",), buckets=64)
    first, middle, end = (datetime.fromisoformat(t).replace(tzinfo=timezone.utc) for t in (START, MIDDLE, END))
    table.advance(states, middle, "r1", first)
    table.advance(states, end, "r2")
    return table.read()


LOOKUP_SQL = """
card as (select * from (select *, row_number() over (partition by cc_num order by ts desc, t_id desc) as rn from feat)
         where rn = 1 and ts >= timestamp '2024-01-31 00:00:00' - interval 1 day),
merch as (select * from (select *, row_number() over (partition by merchant_id order by ts desc, t_id desc) as rn
                         from feat)
          where rn = 1 and ts >= timestamp '2024-01-31 00:00:00' - interval 6 hour),
found as (select p.cc_num, p.merchant_id, c.cc_cnt_10m, cast(c.cc_sum_amt_10m as real) as cc_sum_amt_10m, c.cc_cnt_1h,
                 m.m_fraud_cnt_7d
          from (select distinct cc_num, merchant_id from tx) p
          left join card c on c.cc_num = p.cc_num left join merch m on m.merchant_id = p.merchant_id)"""


def _found(spark, sf_dir):
    online = {
        CARD.name: (CARD, CARD.project(silver.card_snapshot(card_states(spark, sf_dir)))),
        MERCHANT.name: (MERCHANT, MERCHANT.project(silver.merchant_snapshot(merchant_states(spark, sf_dir)))),
    }
    requests = tx(spark, sf_dir).select("cc_num", "merchant_id").distinct()
    return lookup(requests, online, REFERENCES, ntz(AS_OF), key_ttl_seconds=30 * DAY)


@query("online_lookup", with_tx("select * from found", FEATURES_SQL, LOOKUP_SQL))
def online_lookup(spark, sf_dir):
    return _found(spark, sf_dir)


@query(
    "lookup_missing",
    with_tx(
        " union all ".join(
            f"select cc_num, merchant_id, '{name}' as feature from found where {name} is null" for name in NAMES
        ),
        FEATURES_SQL,
        LOOKUP_SQL,
    ),
)
def lookup_missing(spark, sf_dir):
    return missing_values(_found(spark, sf_dir), ["cc_num", "merchant_id"], NAMES)
