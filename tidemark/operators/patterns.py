"""Fraud patterns as queries over the event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, require
from tidemark.functions.scalars import ipv4_number, ipv4_prefix
from tidemark.operators.history import Lag, Rolling, history
from tidemark.operators.tiles import DEFAULT_POLICY, SkewPolicy, measure


def _with_previous(tx: DataFrame, columns: Sequence[str], policy: SkewPolicy) -> DataFrame:
    lags = [Lag("prev_epoch"), *(Lag(f"prev_{c}", c) for c in columns)]
    return history(tx, ["cc_num"], "ts_epoch", ["t_id"], lags=lags, policy=policy).withColumn(
        "gap_s", F.col("ts_epoch") - F.col("prev_epoch")
    )


def impossible_travel(
    tx: DataFrame, min_gap_s: int = 5 * 60, max_gap_s: int = 60 * 60, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Two consecutive card-present events of a card, in two countries, ``min_gap_s``..``max_gap_s`` apart."""
    paired = _with_previous(tx, ["t_id", "country", "card_present"], policy)
    return paired.filter(
        F.col("card_present")
        & F.col("prev_card_present")
        & (F.col("country") != F.col("prev_country"))
        & F.col("gap_s").between(min_gap_s, max_gap_s)
    )


def fast_country_change(
    tx: DataFrame, min_hours: float = 6, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Consecutive events of a card in different countries less than ``min_hours`` apart."""
    paired = _with_previous(tx, ["country"], policy)
    return paired.filter((F.col("country") != F.col("prev_country")) & (F.col("gap_s") < int(min_hours * 3600)))


def burst_chains(
    tx: DataFrame,
    max_gap_s: int = 120 * 60,
    min_events: int = 5,
    max_span_s: int | None = 120 * 60,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Chains of online events of one card in one country with no pause above ``max_gap_s``.

    A chain is cut where the pause is too long; chains are numbered by a running count of cuts.
    ``escalates`` tells whether the last amount exceeds the first.
    """
    keys = ["cc_num", "country"]
    online = require(tx, [*keys, "t_id", "ts_epoch", "amount", "channel"]).filter(F.col("channel") == "online")
    online = online.select("t_id", *keys, "ts_epoch", "amount")
    load = measure(online, keys, F.col("ts_epoch"), policy)
    paired = history(online, keys, "ts_epoch", ["t_id"], lags=[Lag("prev_epoch")], load=load)
    starts = F.coalesce(F.col("ts_epoch") - F.col("prev_epoch") > max_gap_s, F.lit(True)).cast("int")
    numbered = history(
        paired.withColumn("starts", starts), keys, "ts_epoch", ["t_id"], [Rolling("chain", None, "starts")], load=load
    )
    order = F.struct("ts_epoch", "t_id")
    chains = numbered.groupBy(*keys, "chain").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("ts_epoch").alias("start_epoch"),
        F.max("ts_epoch").alias("end_epoch"),
        F.sum("amount").cast("double").alias("sum_amount"),
        F.min_by("amount", order).cast("double").alias("first_amount"),
        F.max_by("amount", order).cast("double").alias("last_amount"),
    )
    chains = chains.filter(F.col("n_events") >= min_events)
    if max_span_s is not None:
        chains = chains.filter(F.col("end_epoch") - F.col("start_epoch") <= max_span_s)
    return chains.withColumn("escalates", F.col("last_amount") > F.col("first_amount")).drop("chain")


def network_country(tx: DataFrame, networks: DataFrame, lengths: Sequence[int], ip: str = "ip_address") -> DataFrame:
    """Add ``ip_country``, the country of the longest network that contains the address.

    ``networks`` has (cidr, country), ``lengths`` the prefix lengths in use, at most 33. One equi-join on
    the leading bits per length instead of a range join.
    """
    if len(set(lengths)) != len(lengths) or not all(0 < n <= 32 for n in lengths):
        raise ContractError(f"prefix lengths {list(lengths)}")
    base, _, bits = (F.split("cidr", "/")[0], None, F.split("cidr", "/")[1].cast("int"))
    parsed = networks.select(ipv4_number(base).alias("__base"), bits.alias("__bits"), F.col("country").alias("__c"))
    out = tx.withColumn("__ip", ipv4_number(F.col(ip)))
    hits = []
    for n in sorted(lengths, reverse=True):
        nets = (
            parsed.filter(F.col("__bits") == n)
            .groupBy(ipv4_prefix(F.col("__base"), n).alias(f"__p{n}"))
            .agg(F.min("__c").alias(f"__c{n}"))
        )
        out = out.withColumn(f"__p{n}", ipv4_prefix(F.col("__ip"), n)).join(nets, f"__p{n}", "left")
        hits.append(F.col(f"__c{n}"))
    return out.select(*tx.columns, F.coalesce(*hits).alias("ip_country"))


def flat_networks(networks: DataFrame) -> DataFrame:
    """(block, start, country): nested networks (cidr, country) as intervals that do not overlap, cut at blocks of 65,536
    addresses. An interval reaches to the next start of its block; its country is that of the longest network over it, NULL
    where there is none. Of equal networks the smallest country counts.

    Networks nest, so at any address the newest network opened of each length is the only one of that length that can still
    be open: one sorted pass carries the newest of each length, whatever their number.
    """
    base, bits = F.split("cidr", "/")[0], F.try_element_at(F.split("cidr", "/"), F.lit(2)).try_cast("int")
    parsed = networks.select(ipv4_number(base).alias("at"), bits.alias("bits"), "country")
    parsed = parsed.filter(F.col("at").isNotNull() & F.col("bits").between(0, 32) & F.col("country").isNotNull())
    span = F.expr("shiftleft(1L, 32 - bits)")
    start = F.col("at") - F.pmod(F.col("at"), span)
    nets = parsed.groupBy(start.alias("start"), "bits").agg(F.min("country").alias("country")).withColumn("end", F.col("start") + span - 1)
    # A network above a block's size stands in each of its blocks; of these only the longest matters there.
    wide = nets.filter(F.col("bits") < 16).withColumn("block", F.explode(F.sequence(F.shiftright("start", 16), F.shiftright("end", 16))))
    wide = wide.groupBy("block").agg(F.max_by("country", "bits").alias("country"))
    first = F.shiftleft(F.col("block").cast("bigint"), 16)
    wide = wide.select("block", first.alias("start"), (first + 65_535).alias("end"), F.lit(15).alias("bits"), "country")
    fine = nets.filter(F.col("bits") >= 16).select(F.shiftright("start", 16).alias("block"), "start", "end", "bits", "country")
    opened = wide.unionByName(fine)
    edges = F.array(F.struct(F.col("start").alias("at"), F.struct("end", "country").alias("net")), F.struct((F.col("end") + 1).alias("at"), F.lit(None).alias("net")))
    rows = opened.select("block", "bits", F.explode(edges).alias("edge")).select("block", "bits", "edge.*")
    rows = rows.filter(F.shiftright("at", 16) == F.col("block"))
    so_far = Window.partitionBy("block").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    lengths = range(32, 14, -1)
    carried = {f"n{n}": F.last(F.when(F.col("bits") == n, F.col("net")), ignorenulls=True).over(so_far) for n in lengths}
    open_ = [F.when(F.col(f"n{n}.end") >= F.col("at"), F.col(f"n{n}.country")) for n in lengths]
    starts = rows.withColumns(carried).groupBy("block", "at").agg(F.first(F.coalesce(*open_)).alias("country"))
    return starts.select("block", F.col("at").alias("start"), "country")


def network_country_flat(tx: DataFrame, networks: DataFrame, ip: str = "ip_address", spread: int = 16) -> DataFrame:
    """:func:`network_country` for networks of any lengths at once: addresses and intervals are sorted together and the last
    interval is carried forward. One exchange of the events, however many lengths there are.

    A block's addresses go to ``spread`` groups, each with all intervals of the block, so a block that holds a third of all events is
    not one task; addresses that are none go round all groups.
    """
    salt = F.pmod(F.xxhash64(*[c for c, t in tx.dtypes if not t.startswith(("map", "array", "struct"))]), F.lit(spread))
    number = ipv4_number(F.col(ip))
    events = tx.select(
        F.coalesce(F.shiftright(number, 16), -1 - F.pmod(F.xxhash64(ip, salt), F.lit(4096))).cast("bigint").alias("__block"),
        salt.alias("__salt"), number.alias("__at"), F.lit(1).alias("__side"), F.struct(*tx.columns).alias("__row"),
    )
    flat = flat_networks(networks)
    intervals = flat.select(
        F.col("block").cast("bigint").alias("__block"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("__salt"),
        F.col("start").alias("__at"), F.lit(0).alias("__side"), F.struct("country").alias("__hit"),
    )
    so_far = Window.partitionBy("__block", "__salt").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    stacked = events.unionByName(intervals, allowMissingColumns=True)
    found = stacked.withColumn("__hit", F.last("__hit", ignorenulls=True).over(so_far)).filter("__row is not null")
    return found.select("__row.*", F.col("__hit.country").alias("ip_country"))


def ip_country_conflicts(tx: DataFrame, networks: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Events whose address lies outside their country's networks (or in none)."""
    return network_country(tx, networks, lengths).filter(~F.col("ip_country").eqNullSafe(F.col("country")))


def in_country_box(tx: DataFrame, boxes: DataFrame) -> DataFrame:
    """Add ``in_box``: does the position lie in the box of the event's country? NULL without a box."""
    box = boxes.select("country", F.struct("lat_min", "lat_max", "lon_min", "lon_max").alias("__b"))
    inside = F.col("lat").between(F.col("__b.lat_min"), F.col("__b.lat_max")) & F.col("lon").between(
        F.col("__b.lon_min"), F.col("__b.lon_max")
    )
    return tx.join(box, "country", "left").withColumn("in_box", inside).drop("__b")


def travel_mix(tx: DataFrame, homes: DataFrame, neighbours: DataFrame, by: Sequence[str] = ("cc_num",)) -> DataFrame:
    """Per group, how many events happened at home, in a neighbour country, or elsewhere.

    ``homes``: (cc_num, home_country); ``neighbours``: (home_country, country) edges.
    """
    edges = neighbours.select("home_country", "country").distinct().withColumn("__edge", F.lit(True))
    placed = tx.join(homes.select("cc_num", "home_country"), "cc_num", "left").join(
        edges, ["home_country", "country"], "left"
    )
    home = F.col("country") == F.col("home_country")
    near = ~home & F.col("__edge").isNotNull()
    far = ~home & F.col("__edge").isNull()
    return placed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(home).alias("n_home"),
        F.count_if(near).alias("n_neighbour"),
        F.count_if(far).alias("n_international"),
    )
