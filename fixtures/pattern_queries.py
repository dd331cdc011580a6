"""Fraud patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.registry import query
from fixtures.views import table, tx, tx_geo, with_tx
from tidemark.operators import patterns

PREVIOUS_SQL = """
prev as (select *, ts_epoch - lag(ts_epoch) over w as gap_s, lag(t_id) over w as prev_t_id,
                lag(country) over w as prev_country, lag(card_present) over w as prev_card_present
         from tx window w as (partition by cc_num order by ts_epoch, t_id))"""


@query(
    "impossible_travel",
    with_tx(
        "select t_id, prev_t_id, cc_num, country, prev_country, gap_s from prev where card_present and prev_card_present "
        "and country <> prev_country and gap_s between 300 and 3600",
        PREVIOUS_SQL,
    ),
)
def impossible_travel(spark, sf_dir):
    found = patterns.impossible_travel(tx_geo(spark, sf_dir).select("t_id", "cc_num", "ts_epoch", "country", "card_present"))
    return found.select("t_id", "prev_t_id", "cc_num", "country", "prev_country", "gap_s")


@query(
    "fast_country_change",
    with_tx(
        "select t_id, cc_num, country, prev_country, gap_s from prev where country <> prev_country and gap_s < 21600",
        PREVIOUS_SQL,
    ),
)
def fast_country_change(spark, sf_dir):
    found = patterns.fast_country_change(tx_geo(spark, sf_dir).select("t_id", "cc_num", "ts_epoch", "country"))
    return found.select("t_id", "cc_num", "country", "prev_country", "gap_s")


@query(
    "burst_chain",
    with_tx(
        """
        select cc_num, country, count(*) as n_events, min(ts_epoch) as start_epoch, max(ts_epoch) as end_epoch,
               cast(sum(amount) as double) as sum_amount,
               cast(arg_min(amount, ts_epoch * 1000000000 + t_id) as double) as first_amount,
               cast(arg_max(amount, ts_epoch * 1000000000 + t_id) as double) as last_amount,
               arg_max(amount, ts_epoch * 1000000000 + t_id) > arg_min(amount, ts_epoch * 1000000000 + t_id) as escalates
        from (select *, sum(starts) over (partition by cc_num, country order by ts_epoch, t_id) as chain
              from (select *, case when ts_epoch - lag(ts_epoch) over
                              (partition by cc_num, country order by ts_epoch, t_id) <= 43200 then 0 else 1 end as starts
                    from tx where channel = 'online'))
        group by cc_num, country, chain having count(*) >= 5
        """
    ),
)
def burst_chain(spark, sf_dir):
    return patterns.burst_chains(tx_geo(spark, sf_dir), max_gap_s=12 * 3600, max_span_s=None)


def _networks(spark, sf_dir):
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat((n + 10).cast("string"), F.lit(".0.0.0/8")).alias("cidr"), n.alias("country")
    )


@query(
    "ip_country",
    with_tx(
        "select t_id, ip_address, country, cast(split_part(ip_address, '.', 1) as integer) - 10 as ip_country from tx "
        "where cast(split_part(ip_address, '.', 1) as integer) - 10 <> country"
    ),
)
def ip_country(spark, sf_dir):
    events = tx_geo(spark, sf_dir).select("t_id", "ip_address", "country")
    return patterns.ip_country_conflicts(events, _networks(spark, sf_dir), [8])


SUPPLIER_NET = "concat_ws('.', cast(s_nationkey + 10 as {text}), cast(s_suppkey % 256 as {text}), cast(s_suppkey * 7 % 256 as {text}), '9')"
NETWORKS_SQL = f"""
cidrs as (select concat_ws('.', cast(n_nationkey + 10 as varchar), '0', '0', '0') as base, 8 as bits, n_nationkey as country from nation
          union all select {SUPPLIER_NET.format(text="varchar")}, 1 + s_suppkey % 32, cast(s_suppkey % 25 as integer) from supplier),
nets as (select *, addr - addr % cast(pow(2, 32 - bits) as bigint) as first from (select *, cast(split_part(base, '.', 1) as bigint) * 16777216
         + cast(split_part(base, '.', 2) as bigint) * 65536 + cast(split_part(base, '.', 3) as bigint) * 256
         + cast(split_part(base, '.', 4) as bigint) as addr from cidrs)),
ips as (select ip_address, any_value(cast(split_part(ip_address, '.', 1) as bigint) * 16777216 + cast(split_part(ip_address, '.', 2) as bigint)
        * 65536 + cast(split_part(ip_address, '.', 3) as bigint) * 256 + cast(split_part(ip_address, '.', 4) as bigint)) as ip from tx group by 1),
hit as (select ip_address, country, row_number() over (partition by ip_address order by bits desc, country) as rn
        from ips join nets on ip between first and first + cast(pow(2, 32 - bits) as bigint) - 1)"""


@query(
    "ip_country_flat",
    with_tx(
        "select t_id, tx.ip_address, hit.country as ip_country from tx left join hit on hit.ip_address = tx.ip_address and rn = 1",
        NETWORKS_SQL,
    ),
)
def ip_country_flat(spark, sf_dir):
    """Nested networks of all 32 lengths: the nations' and one per supplier."""
    base = F.expr(SUPPLIER_NET.format(text="string"))
    cidr = F.concat(base, F.lit("/"), (1 + F.col("s_suppkey") % 32).cast("string"))
    own = table(spark, sf_dir, "supplier").select(cidr.alias("cidr"), (F.col("s_suppkey") % 25).cast("int").alias("country"))
    networks = _networks(spark, sf_dir).unionByName(own)
    return patterns.network_country_flat(tx_geo(spark, sf_dir).select("t_id", "ip_address"), networks)


@query(
    "geo_box",
    with_tx(
        "select t_id, lat between country * 5 - 90 and country * 5 - 30 and lon between country * 10 - 180 "
        "and country * 10 - 60 as in_box from tx"
    ),
)
def geo_box(spark, sf_dir):
    n = F.col("n_nationkey")
    boxes = table(spark, sf_dir, "nation").select(
        n.alias("country"),
        (n * 5 - 90).cast("double").alias("lat_min"),
        (n * 5 - 30).cast("double").alias("lat_max"),
        (n * 10 - 180).cast("double").alias("lon_min"),
        (n * 10 - 60).cast("double").alias("lon_max"),
    )
    return patterns.in_country_box(tx_geo(spark, sf_dir), boxes).select("t_id", "in_box")


@query(
    "travel_mix",
    with_tx(
        "select tx.cc_num, count(*) as n_events, count(*) filter (country = c_nationkey) as n_home, "
        "count(*) filter (country in ((c_nationkey + 1) % 25, (c_nationkey + 24) % 25)) as n_neighbour, "
        "count(*) filter (country not in (c_nationkey, (c_nationkey + 1) % 25, (c_nationkey + 24) % 25)) "
        "as n_international from tx join customer on c_custkey = cc_num group by 1"
    ),
)
def travel_mix(spark, sf_dir):
    homes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cc_num"), F.col("c_nationkey").alias("home_country")
    )
    n = F.col("n_nationkey")
    ring = table(spark, sf_dir, "nation").select(
        n.alias("home_country"), F.explode(F.array((n + 1) % 25, (n + 24) % 25)).alias("country")
    )
    return patterns.travel_mix(tx_geo(spark, sf_dir), homes, ring)
