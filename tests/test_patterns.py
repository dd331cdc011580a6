from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scalars import ipv4_number, ipv4_text, percent
from tidemark.operators import patterns
from tidemark.operators.tiles import SkewPolicy

TILED = SkewPolicy(0, 2)
NETWORKS = {"US": "10.0.0.0/8", "CA": "172.16.0.0/12", "GB": "100.64.0.0/10", "FR": "198.18.0.0/15", "DE": "198.51.100.0/24"}
BOXES = {"FR": (42.0, 51.0, -5.0, 8.0), "SE": (55.0, 69.0, 11.0, 24.0)}
NEIGHBOURS = {"FR": ["DE"], "SE": ["DE"]}


def events(spark, *drawn):
    full = [(f"t{i}", k, s, c, present, "pos" if present else "online", Decimal(a)) for i, (k, s, c, present, a) in enumerate(drawn)]
    return spark.createDataFrame(
        full, "t_id string, cc_num string, ts_epoch long, country string, card_present boolean, channel string, amount decimal(18,2)"
    )


def test_travel_rules(spark):
    df = events(
        spark,
        ("a", 0, "SE", True, 1),
        ("a", 300, "FR", True, 1),  # 5 minutes: impossible
        ("a", 599, "SE", True, 1),  # under 5 minutes: only a fast change
        ("a", 9000, "SE", True, 1),
        ("a", 12600, "DE", True, 1),  # exactly an hour
        ("a", 12900, "FR", False, 1),  # not present
        ("a", 90000, "SE", True, 1),
    )
    for policy in (SkewPolicy(), TILED):
        assert sorted(r.t_id for r in patterns.impossible_travel(df, policy=policy).collect()) == ["t1", "t4"]
        assert sorted(r.t_id for r in patterns.fast_country_change(df, policy=policy).collect()) == ["t1", "t2", "t4", "t5"]


def test_burst_chains(spark):
    chain = [("a", 1000 * i, "SE", False, i + 1) for i in range(6)]
    df = events(spark, *chain, ("a", 2500, "SE", True, 9), ("a", 2600, "FR", False, 9), ("a", 50000, "SE", False, 1))
    for policy in (SkewPolicy(), TILED):
        found = patterns.burst_chains(df, max_gap_s=1000, min_events=5, max_span_s=5000, policy=policy).collect()
        assert [(r.cc_num, r.country, r.n_events, r.sum_amount, r.escalates) for r in found] == [("a", "SE", 6, 21.0, True)]
    assert patterns.burst_chains(df, 999, 5).count() == 0 and patterns.burst_chains(df, 1000, 5, 4999).count() == 0


def test_networks(spark):
    nets = spark.createDataFrame([(v, k) for k, v in NETWORKS.items()], "cidr string, country string")
    nets = nets.union(spark.createDataFrame([("10.1.0.0/16", "XX")], nets.schema))
    lengths = [8, 12, 16, 10, 15, 24]
    ips = ["10.0.0.1", "10.1.2.3", "172.31.255.255", "172.32.0.0", "100.127.0.1", "198.19.0.1", "198.51.100.7", "nope", "1.2.3.999"]
    df = spark.createDataFrame([(ip, "US") for ip in ips], "ip_address string, country string")
    got = {r.ip_address: r.ip_country for r in patterns.network_country(df, nets, lengths).collect()}
    assert [got[ip] for ip in ips] == ["US", "XX", "CA", None, "GB", "FR", "DE", None, None]
    assert patterns.ip_country_conflicts(df, nets, lengths).count() == 8
    plan = patterns.network_country(df, nets, lengths)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_boxes_and_mix(spark):
    boxes = spark.createDataFrame([(k, *v) for k, v in BOXES.items()], "country string, lat_min double, lat_max double, lon_min double, lon_max double")
    df = spark.createDataFrame([("FR", 48.8, 2.3), ("SE", 48.8, 2.3), ("JP", 1.0, 1.0)], "country string, lat double, lon double")
    assert {r.country: r.in_box for r in patterns.in_country_box(df, boxes).collect()} == {"FR": True, "SE": False, "JP": None}
    edges = spark.createDataFrame([(h, c) for h, cs in NEIGHBOURS.items() for c in cs], "home_country string, country string")
    tx = spark.createDataFrame([("a", c) for c in ["FR", "FR", "DE", "SE"]], "cc_num string, country string")
    homes = spark.createDataFrame([("a", "FR")], "cc_num string, home_country string")
    assert rows(patterns.travel_mix(tx, homes, edges)) == [("a", 4, 2, 1, 1)]


def test_addresses(spark):
    df = spark.createDataFrame([("255.0.1.2", 1, 0)], "ip string, a int, b int")
    n = ipv4_number(F.col("ip"))
    row = df.select(n.alias("n"), ipv4_text(n).alias("t"), percent(F.col("a"), F.col("b")).alias("p")).first()
    assert (row.n, row.t, row.p) == (255 * 2**24 + 258, "255.0.1.2", 0.0)
