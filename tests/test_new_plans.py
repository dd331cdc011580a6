"""Band as-of join, longest network over sorted intervals, deduplication of a stream."""

import ipaddress
import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators.asof import asof_band, asof_join
from tidemark.operators.patterns import flat_networks, network_country_flat
from tidemark.streaming.incremental import dedupe_available

T0 = datetime(2026, 1, 1)


def test_band_equals_sorted_pass(spark):
    pick = random.Random(4)
    when = lambda: None if pick.random() < 0.05 else T0 + timedelta(seconds=pick.choice([0, 50, 99, 100, 101, pick.randrange(1000)]))
    key = lambda: pick.choice(["a", "a", "b", None])
    left = spark.createDataFrame([(i, key(), when()) for i in range(150)], "id int, k string, ts timestamp_ntz")
    right = spark.createDataFrame([(i, key(), when(), i * 10 if i % 7 else None) for i in range(150)], "rid int, k string, rts timestamp_ntz, v int")
    for exact in (True, False):
        args = (left, right, ["k"], ["k"], "ts", "rts")
        more = dict(names={"rid": "r_rid", "v": "r_v"}, allow_exact=exact, matched_ts="at")
        found = asof_band(*args, ["id"], 100, ["rid"], **more)
        assert rows(found) == rows(asof_join(*args, ["rid"], ttl_seconds=100, **more))
    assert asof_band(left, right.limit(0), ["k"], ["k"], "ts", "rts", ["id"], 100).count() == 150
    with pytest.raises(ContractError, match="age"):
        asof_band(left, right, ["k"], ["k"], "ts", "rts", ["id"], 0)
    with pytest.raises(ContractError, match="repeat"):
        asof_band(left, right.withColumn("id", right.rid), ["k"], ["k"], "ts", "rts", ["id"], 100)
    # No pair is made beyond a row's own bucket and the one before: the join is an equi-join on key and bucket.
    plan = asof_band(left, right, ["k"], ["k"], "ts", "rts", ["id"], 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("Join Inner, ") == 1 and "__b" in plan.split("Join Inner, ")[1].split("\n")[0]


def test_longest_network(spark):
    pick = random.Random(9)
    nets = [("0.0.0.0/1", "half"), ("10.0.0.0/8", "ten"), ("10.1.0.0/16", "x"), ("10.1.0.0/16", "w"), ("10.1.255.0/24", "end"), ("10.2.0.0/15", "two"), ("255.255.255.255/32", "last")]
    for _ in range(150):
        nets.append((f"10.{pick.choice([1, 2, 3])}.{pick.choice([0, 1, 255])}.{pick.randrange(256)}/{pick.randrange(33)}", f"c{pick.randrange(9)}"))
    nets = [n for n in nets if n[0].split("/")[1] != "0"] + [("bad", "c"), ("1.2.3.4/40", "c"), (None, "c"), ("9.9.9.9/32", None)]
    ips = [f"10.{pick.choice([0, 1, 2, 3])}.{pick.choice([0, 1, 254, 255])}.{pick.randrange(256)}" for _ in range(300)]
    ips += ["0.0.0.0", "255.255.255.255", "200.1.1.1", "9.9.9.9", "not one", None, None, "1.2.3.400"]
    parsed = []
    for cidr, country in nets:
        try:
            parsed.append((ipaddress.ip_network(cidr, strict=False), country))
        except (ValueError, AttributeError):
            pass

    def brute(ip):
        try:
            address = ipaddress.ip_address(ip)
        except ValueError:
            return None
        over = [(-n.prefixlen, c) for n, c in parsed if address in n and c is not None]
        return min(over)[1] if over else None

    events = spark.createDataFrame(list(enumerate(ips)), "id int, ip_address string")
    networks = spark.createDataFrame(nets, "cidr string, country string")
    found = network_country_flat(events, networks)
    assert rows(found) == sorted(((i, ip, brute(ip)) for i, ip in enumerate(ips)), key=repr)
    assert rows(network_country_flat(events, networks, spread=1)) == rows(found)
    assert network_country_flat(events, networks.limit(0)).filter("ip_country is not null").count() == 0
    flat = flat_networks(networks.filter("cidr like '10.1.%'"))
    assert flat.groupBy("block", "start").count().filter("count > 1").count() == 0
    # The events are exchanged once; all other exchanges are the networks'.
    plan = network_country_flat(events, networks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(__block") == 1


def test_copies_in_a_stream(spark, tmp_path):
    feed, target, checkpoint = (str(tmp_path / n) for n in ("feed", "target", "checkpoint"))
    schema = "id int, ts timestamp, n int"

    def push(*new):
        spark.createDataFrame([(i, s if s is None else T0 + timedelta(seconds=s), n) for i, s, n in new], schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        dedupe_available(stream, ["id"], "ts", "100 seconds", target, checkpoint).awaitTermination()
        return rows(spark.read.schema(schema).parquet(target).select("id", "n"))

    assert push((1, 0, 1), (2, 5, 2), (2, 5, 2), (3, None, 3)) == [(1, 1), (2, 2)]
    assert push((1, 50, 9), (4, 60, 4)) == [(1, 1), (2, 2), (4, 4)]  # a copy after a restart
    assert push((5, 900, 5)) == [(1, 1), (2, 2), (4, 4), (5, 5)]
    assert push((6, 10, 6), (1, 950, 10)) == [(1, 1), (1, 10), (2, 2), (4, 4), (5, 5)]  # too late; no copy any more
