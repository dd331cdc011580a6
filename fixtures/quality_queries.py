"""The data-quality gate on raw tables with faults.

The raw tables are the transaction and label views as text, with faults where the amount falls into
some range; the known entities leave some ids out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.registry import query
from fixtures.views import table, tx_geo, with_tx
from tidemark.functions.times import iso_text
from tidemark.operators import quality
from tidemark.operators.events import in_bounds

# Category number -> name, in this order.
CATEGORIES = ["grocery", "fuel", "restaurant", "ecommerce", "travel", "electronics", "pharmacy", "other"]

RAW_SQL = f"""
raw_tx as (
  select cast(t_id - case when event_type = 'signup' and amount < 1 then 1 else 0 end as varchar) as t_id,
         case when amount <= 250 then cast(cc_num as varchar) end as cc_num,
         cast(account_id as varchar) as account_id, cast(merchant_id as varchar) as merchant_id,
         cast(amount - 1 as decimal(18,2)) as amount, currency, cast(country as varchar) as country, ip_address,
         card_present, channel, {CATEGORIES}[category + 1] as category,
         lat + case when amount > 200 then 100 else 0 end as lat, lon,
         case when amount < 0.3 then 'not a time' when amount < 0.6 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
              else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as ts
  from tx),
raw_lab0 as (
  select cast(t_id + case when amount > 150 then 1000000000 else 0 end as varchar) as t_id,
         cast(cc_num + case when amount between 100 and 150 then 1 else 0 end as varchar) as cc_num,
         case when amount >= 2 then 'chain_attack' end as explanation,
         case when amount < 3 then 'soon' when amount < 5 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
              when amount < 10 then strftime(ts - interval 1 hour, '%Y-%m-%dT%H:%M:%SZ')
              else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as ts, amount
  from tx where label_is_fraud = 1),
raw_lab as (select t_id, cc_num, explanation, ts from raw_lab0 union all
            select t_id, cc_num, explanation, ts from raw_lab0 where amount between 40 and 42),
cards as (select cast(c_custkey as varchar) as cc_num from customer where c_acctbal >= 0),
accounts as (select cast(c_custkey as varchar) as account_id from customer where c_acctbal < 9900),
merchants as (select distinct cast(merchant_id as varchar) as merchant_id from tx where card_present and amount > 110),
tx_times as (select t_id, max(cc_num) as cc_num, max(try_cast(ts as timestamp)) as ts from raw_tx group by 1)"""


def gate_inputs(spark, sf_dir) -> quality.GateInputs:
    base = tx_geo(spark, sf_dir)
    amount, ts = F.col("amount"), F.col("ts")
    naive = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    names = F.array(*(F.lit(c) for c in CATEGORIES))
    shifted = F.when((F.col("event_type") == "signup") & (amount < 1), 1).otherwise(0)
    raw = base.select(
        (F.col("t_id") - shifted).cast("string").alias("t_id"),
        F.when(amount <= 250, F.col("cc_num").cast("string")).alias("cc_num"),
        F.col("account_id").cast("string"),
        F.col("merchant_id").cast("string"),
        (amount - 1).cast("decimal(18,2)").alias("amount"),
        "currency",
        F.col("country").cast("string"),
        "ip_address",
        "card_present",
        "channel",
        F.element_at(names, (F.col("category") + 1).cast("int")).alias("category"),
        (F.col("lat") + F.when(amount > 200, 100).otherwise(0)).alias("lat"),
        "lon",
        F.when(amount < 0.3, "not a time").when(amount < 0.6, naive).otherwise(iso_text(ts)).alias("ts"),
    )
    early = iso_text(ts - F.make_dt_interval(hours=F.lit(1)))
    marked = base.filter("label_is_fraud = 1").select(
        (F.col("t_id") + F.when(amount > 150, 1_000_000_000).otherwise(0)).cast("string").alias("t_id"),
        (F.col("cc_num") + F.when(amount.between(100, 150), 1).otherwise(0)).cast("string").alias("cc_num"),
        F.when(amount >= 2, "chain_attack").alias("explanation"),
        F.when(amount < 3, "soon").when(amount < 5, naive).when(amount < 10, early).otherwise(iso_text(ts)).alias("ts"),
        "amount",
    )
    labels = marked.unionAll(marked.filter(F.col("amount").between(40, 42))).drop("amount")
    customers = table(spark, sf_dir, "customer")
    ids = F.col("c_custkey").cast("string")
    merchants = base.filter(F.col("card_present") & (amount > 110)).select(F.col("merchant_id").cast("string"))
    return quality.GateInputs(
        raw,
        labels,
        customers.filter("c_acctbal >= 0").select(ids.alias("cc_num")),
        customers.filter("c_acctbal < 9900").select(ids.alias("account_id")),
        merchants.distinct(),
    )


RULES_SQL = {
    "tx_required": "select t_id, 'cc_num' from raw_tx where cc_num is null",
    "tx_amount": "select t_id, cast(amount as varchar) from raw_tx where amount < 0",
    "tx_position": "select t_id, cast(cast(lat as bigint) as varchar) || ',' || cast(cast(lon as bigint) as varchar) "
    "from raw_tx where not (lat between -90 and 90 and lon between -180 and 180)",
    "tx_card": "select t_id, cc_num from raw_tx where cc_num not in (select cc_num from cards)",
    "tx_account": "select t_id, account_id from raw_tx where account_id not in (select account_id from accounts)",
    "tx_merchant": "select t_id, merchant_id from raw_tx where merchant_id not in (select merchant_id from merchants)",
    "tx_ts_unreadable": "select t_id, ts from raw_tx where try_cast(ts as timestamp) is null",
    "tx_ts_naive": "select t_id, ts from raw_tx where try_cast(ts as timestamp) is not null and ts not like '%Z'",
    "tx_duplicate": "select t_id, cast(count(*) as varchar) from raw_tx group by 1 having count(*) > 1",
    "label_required": "select t_id, 'explanation' from raw_lab where explanation is null",
    "label_unknown_tx": "select t_id, t_id from raw_lab where t_id not in (select t_id from raw_tx)",
    "label_card_differs": "select l.t_id, l.cc_num from raw_lab l join tx_times t using (t_id) where l.cc_num <> t.cc_num",
    "label_card": "select t_id, cc_num from raw_lab where cc_num not in (select cc_num from cards)",
    "label_before_tx": "select l.t_id, l.ts from raw_lab l join tx_times t using (t_id) "
    "where try_cast(l.ts as timestamp) < t.ts",
    "label_ts_unreadable": "select t_id, ts from raw_lab where try_cast(ts as timestamp) is null",
    "label_ts_naive": "select t_id, ts from raw_lab where try_cast(ts as timestamp) is not null and ts not like '%Z'",
    "label_duplicate": "select t_id, cast(count(*) as varchar) from raw_lab group by 1 having count(*) > 1",
}


def _rules_sql(*rules: str) -> str:
    parts = (f"select '{r}' as rule, v.* from ({RULES_SQL[r]}) v(key, detail)" for r in rules or RULES_SQL)
    return " union all ".join(parts)


@query("dq_violations", with_tx(_rules_sql(), RAW_SQL))
def dq_violations(spark, sf_dir):
    return quality.violations(gate_inputs(spark, sf_dir))


@query("dq_summary", with_tx(f"select rule, count(*) as n_violations from ({_rules_sql()}) group by 1", RAW_SQL))
def dq_summary(spark, sf_dir):
    return quality.summarize(quality.violations(gate_inputs(spark, sf_dir)))


@query(
    "dq_counts",
    with_tx(
        "select count(*) as n_tx, count(distinct t_id) as n_tx_ids, (select count(*) from raw_lab) as n_labels from raw_tx",
        RAW_SQL,
    ),
)
def dq_counts(spark, sf_dir):
    return quality.counts(gate_inputs(spark, sf_dir))


@query(
    "dq_ranges",
    with_tx(
        "select t_id, amount < 0 as bad_amount, not (lat between -90 and 90 and lon between -180 and 180) as bad_position "
        "from raw_tx where amount < 0 or not (lat between -90 and 90 and lon between -180 and 180)",
        RAW_SQL,
    ),
)
def dq_ranges(spark, sf_dir):
    off_map = ~(in_bounds(F.col("lat"), -90, 90) & in_bounds(F.col("lon"), -180, 180))
    checked = gate_inputs(spark, sf_dir).tx.select(
        "t_id", (F.col("amount") < 0).alias("bad_amount"), off_map.alias("bad_position")
    )
    return checked.filter("bad_amount or bad_position")


@query("dq_fk", with_tx(f"select key as t_id, detail as cc_num from ({_rules_sql('tx_card')})", RAW_SQL))
def dq_fk(spark, sf_dir):
    inputs = gate_inputs(spark, sf_dir)
    return quality.orphans(inputs.tx.select("t_id", "cc_num"), inputs.cards, "cc_num").select("t_id", "cc_num")


@query("dq_label_fk", with_tx(_rules_sql("label_unknown_tx", "label_card_differs"), RAW_SQL))
def dq_label_fk(spark, sf_dir):
    found = quality.label_violations(gate_inputs(spark, sf_dir))
    return found.filter(F.col("rule").isin("label_unknown_tx", "label_card_differs"))


@query("dq_label_time", with_tx(_rules_sql("label_before_tx"), RAW_SQL))
def dq_label_time(spark, sf_dir):
    return quality.label_violations(gate_inputs(spark, sf_dir)).filter("rule = 'label_before_tx'")


@query("dq_ts", with_tx(_rules_sql("tx_ts_unreadable", "tx_ts_naive"), RAW_SQL))
def dq_ts(spark, sf_dir):
    found = quality.transaction_violations(gate_inputs(spark, sf_dir))
    return found.filter(F.col("rule").isin("tx_ts_unreadable", "tx_ts_naive"))


@query(
    "dq_channel",
    with_tx(
        "select t_id, category, channel, card_present from raw_tx where case "
        "when category = 'ecommerce' then not (channel = 'online' and not card_present) "
        "when category in ('fuel', 'grocery', 'restaurant', 'pharmacy') then not (channel = 'pos' and card_present) "
        "else (channel = 'pos') <> card_present end",
        RAW_SQL,
    ),
)
def dq_channel(spark, sf_dir):
    raw = gate_inputs(spark, sf_dir).tx
    found = quality.channel_conflicts(raw, quality.ONLINE_ONLY, quality.TERMINAL_ONLY)
    return found.select("t_id", "category", "channel", "card_present")
