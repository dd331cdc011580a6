"""Point-in-time joins, training sets, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.history_queries import FEATURES_SQL, card_states, merchant_states
from fixtures.registry import ORACLES, query
from fixtures.views import LABELS_SQL, labels, table, tx, tx_geo, with_tx
from tidemark.operators.asof import asof_band, asof_join, best_per_left_id
from tidemark.operators.tiles import DEFAULT_POLICY, SkewPolicy
from tidemark.operators.events import enrich, stack
from tidemark.plans import silver, training

SIDES_SQL = """
l as (select t_id, cc_num, ts from tx where event_type = 'error'),
r as (select cc_num, ts, t_id as buy_id, amount from tx where event_type = 'purchase'),
r1 as (select cc_num, ts, buy_id, amount from
       (select *, row_number() over (partition by cc_num, ts order by buy_id desc) as rn from r) where rn = 1)"""


def _sides(spark, sf_dir):
    events = tx(spark, sf_dir)
    left = events.filter("event_type = 'error'").select("t_id", "cc_num", "ts")
    right = events.filter("event_type = 'purchase'").select("cc_num", "ts", F.col("t_id").alias("buy_id"), "amount")
    return left, right


@query(
    "asof_join",
    with_tx(
        "select l.t_id, l.cc_num, l.ts, r1.ts as buy_ts, r1.buy_id, r1.amount "
        "from l asof left join r1 on l.cc_num = r1.cc_num and l.ts >= r1.ts",
        SIDES_SQL,
    ),
)
def asof(spark, sf_dir, policy=DEFAULT_POLICY):
    left, right = _sides(spark, sf_dir)
    return asof_join(left, right, ["cc_num"], ["cc_num"], "ts", "ts", ["buy_id"], matched_ts="buy_ts", policy=policy)


@query("asof_tiled", ORACLES["asof_join"])
def asof_tiled(spark, sf_dir):
    return asof(spark, sf_dir, SkewPolicy(frame_rows=0, tile_rows=20))


@query(
    "asof_ttl",
    with_tx(
        "select t_id, cc_num, ts, case when fresh then buy_ts end as buy_ts, case when fresh then buy_id end as buy_id, "
        "case when fresh then amount end as amount from ("
        "select l.t_id, l.cc_num, l.ts, r1.ts as buy_ts, r1.buy_id, r1.amount, r1.ts >= l.ts - interval 3 day as fresh "
        "from l asof left join r1 on l.cc_num = r1.cc_num and l.ts >= r1.ts)",
        SIDES_SQL,
    ),
)
def asof_ttl(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return asof_join(
        left, right, ["cc_num"], ["cc_num"], "ts", "ts", ["buy_id"], ttl_seconds=3 * 86_400, matched_ts="buy_ts"
    )


@query("asof_band", ORACLES["asof_ttl"])
def band(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return asof_band(left, right, ["cc_num"], ["cc_num"], "ts", "ts", ["t_id"], 3 * 86_400, ["buy_id"], matched_ts="buy_ts")


@query(
    "asof_ns",
    with_tx(
        "select l.t_id, l.cc_num, l.ts, l.amount, r1.t_id as prev_t_id, r1.amount as prev_amount, "
        "r1.channel as prev_channel from tx l asof left join "
        "(select * from (select *, row_number() over (partition by cc_num, ts order by t_id desc) as rn from tx) "
        " where rn = 1) r1 on l.cc_num = r1.cc_num and l.ts > r1.ts"
    ),
)
def asof_ns(spark, sf_dir):
    events = tx(spark, sf_dir)
    left = events.select("t_id", "cc_num", "ts", "amount")
    right = events.select("cc_num", "ts", "t_id", "amount", "channel")
    return asof_join(
        left, right, ["cc_num"], ["cc_num"], "ts", "ts", ["t_id"],
        names={"t_id": "prev_t_id", "amount": "prev_amount", "channel": "prev_channel"}, allow_exact=False
    )


@query(
    "asof_join_range",
    with_tx(
        "select left_id, t_id, cc_num, buy_ts, buy_id, amount from ("
        "select l.*, r1.ts as buy_ts, r1.buy_id, r1.amount, row_number() over (partition by l.left_id "
        "order by r1.ts desc nulls last, l.t_id desc) as rn from "
        "(select t_id, cc_num, ts, cc_num * 100 + day(ts) as left_id from l) l "
        "left join r1 on l.cc_num = r1.cc_num and r1.ts <= l.ts) where rn = 1",
        SIDES_SQL,
    ),
)
def asof_join_range(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    left = left.withColumn("left_id", F.col("cc_num") * 100 + F.dayofmonth("ts"))
    joined = asof_join(left, right, ["cc_num"], ["cc_num"], "ts", "ts", ["buy_id"], matched_ts="buy_ts")
    return best_per_left_id(joined, ["left_id"], "buy_ts", ["t_id"]).drop("ts")


CARD_OUT = ", ".join(f"c.{n} as card_{n}" for n in silver.CARD_SNAPSHOT_FEATURES)
MERCHANT_OUT = ", ".join(f"m.{n}" for n in silver.MERCHANT_SNAPSHOT_FEATURES)
BASE_OUT = (
    "l.t_id, l.ts as event_ts, l.cc_num, l.merchant_id, l.amount, l.country, l.category, l.channel, "
    "l.card_present, l.label_is_fraud"
)


def _training_sql(card: str, merchant: str) -> str:
    return with_tx(
        f"select {BASE_OUT}, {CARD_OUT}, {MERCHANT_OUT} from tx l "
        f"asof left join {card} c on l.cc_num = c.cc_num and l.ts >= c.ts "
        f"asof left join {merchant} m on l.merchant_id = m.merchant_id and l.ts >= m.ts",
        FEATURES_SQL,
        *(
            f"""
            {name} as (select * from (select *, row_number() over (partition by {by} order by {order}) as rn from feat)
                       where rn = 1)"""
            for name, by, order in [
                ("card_states", "cc_num, ts", "t_id desc"),
                ("merchant_states", "merchant_id, ts", "t_id desc"),
                ("card_last", "cc_num", "ts desc, t_id desc"),
                ("merchant_last", "merchant_id", "ts desc, t_id desc"),
            ]
        ),
    )


@query("training_set", _training_sql("card_states", "merchant_states"))
def training_set(spark, sf_dir):
    events, known = tx_geo(spark, sf_dir), labels(spark, sf_dir)
    card = silver.card_history(card_states(spark, sf_dir))
    merchant = silver.merchant_history(merchant_states(spark, sf_dir))
    return training.training_set(events, known, card, merchant, tie=("t_id",))


@query("training_set_snapshot", _training_sql("card_last", "merchant_last"))
def training_set_snapshot(spark, sf_dir):
    """Features from the latest-only snapshots: filled where a snapshot is not newer than the event."""
    events, known = tx_geo(spark, sf_dir), labels(spark, sf_dir)
    card = silver.card_snapshot(card_states(spark, sf_dir))
    return training.training_set(events, known, card, silver.merchant_snapshot(merchant_states(spark, sf_dir)))


@query(
    "enrich_dims",
    with_tx(
        "select tx.t_id, tx.cc_num, c.c_nationkey as home_country, n.n_name as home_name, n.n_regionkey as home_region, "
        "mm.merchant_country, mm.merchant_category from tx left join customer c on c.c_custkey = tx.cc_num "
        "left join nation n on n.n_nationkey = c.c_nationkey left join "
        "(select distinct merchant_id, merchant_id % 25 as merchant_country, merchant_id % 8 as merchant_category from tx) mm "
        "on mm.merchant_id = tx.merchant_id"
    ),
)
def enrich_dims(spark, sf_dir):
    events = tx(spark, sf_dir).select("t_id", "cc_num", "merchant_id")
    accounts = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "cc_num")
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "home_country")
    merchants = (
        events.select("merchant_id")
        .distinct()
        .withColumns({"country": F.col("merchant_id") % 25, "category": F.col("merchant_id") % 8})
    )
    out = enrich(events, accounts, "cc_num", {"c_nationkey": "home_country"})
    out = enrich(out, nations, "home_country", {"n_name": "home_name", "n_regionkey": "home_region"})
    out = enrich(out, merchants, "merchant_id", {"country": "merchant_country", "category": "merchant_category"})
    return out.drop("merchant_id")


@query(
    "union_runs",
    with_tx(
        "select t_id, cc_num, amount, null as explanation from tx union all "
        "select t_id, cc_num, null, explanation from lab",
        LABELS_SQL,
    ),
)
def union_runs(spark, sf_dir):
    normal = tx(spark, sf_dir).select("t_id", "cc_num", "amount")
    injected = labels(spark, sf_dir).select("t_id", "cc_num", "explanation")
    return stack([normal, injected])
