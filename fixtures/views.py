"""The card-transaction tables, seen in the given test tables (mapping: FIXTURES.md), in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without the columns that need the customer table."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    present = F.col("event_type").isin("purchase", "signup")
    return e.select(
        F.col("event_id").alias("t_id"),
        F.col("user_id").alias("cc_num"),
        F.col("user_id").alias("account_id"),
        "ts",
        epoch_seconds(F.col("ts")).alias("ts_epoch"),
        k.alias("merchant_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        present.alias("card_present"),
        F.when(present, "pos").otherwise("online").alias("channel"),
        (k % 8).alias("category"),
        ((F.col("event_id") * 37) % 181 - 90).cast("double").alias("lat"),
        ((F.col("event_id") * 91) % 361 - 180).cast("double").alias("lon"),
        "event_type",
        ((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)).cast("int").alias("label_is_fraud"),
    )


def tx_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with country and address, taken from the customer's nation."""
    homes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cc_num"), F.col("c_nationkey").alias("__home")
    )
    moved = (F.col("__home") + 1 + F.col("t_id") % 5) % 25
    country = F.when(F.col("t_id") % 7 == 0, moved).otherwise(F.col("__home")).cast("int")
    address = F.concat_ws(
        ".",
        (F.col("__home") + 10).cast("string"),
        (F.col("t_id") % 256).cast("string"),
        (F.col("cc_num") % 256).cast("string"),
        F.lit("1"),
    )
    joined = tx(spark, sf_dir).join(homes, "cc_num", "left")
    return joined.withColumns({"country": country, "ip_address": address}).drop("__home")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud labels: positives only, each known some hours after its event."""
    marked = tx(spark, sf_dir).filter("label_is_fraud = 1")
    return marked.select(
        "t_id",
        "cc_num",
        "merchant_id",
        F.when(F.col("card_present"), "geo_fraud").otherwise("chain_attack").alias("explanation"),
        "ts",
        (F.col("ts") + F.make_dt_interval(hours=(F.col("t_id") % 72).cast("int"))).alias("label_available_ts"),
    )


# The same views as DuckDB common table expressions.
TX_SQL = """
tx as (
  select e.event_id as t_id, e.user_id as cc_num, e.user_id as account_id, e.ts,
         cast(floor(epoch(e.ts)) as bigint) as ts_epoch,
         cast(json_extract_string(e.props, '$.k') as bigint) as merchant_id,
         cast(e.value as decimal(18,2)) as amount, 'USD' as currency,
         e.event_type in ('purchase', 'signup') as card_present,
         case when e.event_type in ('purchase', 'signup') then 'pos' else 'online' end as channel,
         cast(json_extract_string(e.props, '$.k') as bigint) % 8 as category,
         cast((e.event_id * 37) % 181 - 90 as double) as lat,
         cast((e.event_id * 91) % 361 - 180 as double) as lon,
         e.event_type,
         cast(e.event_type = 'error' and e.event_id % 5 = 0 as integer) as label_is_fraud,
         cast(case when e.event_id % 7 = 0 then (c.c_nationkey + 1 + e.event_id % 5) % 25
                   else c.c_nationkey end as integer) as country,
         concat_ws('.', cast(c.c_nationkey + 10 as varchar), cast(e.event_id % 256 as varchar),
                   cast(e.user_id % 256 as varchar), '1') as ip_address
  from events e left join customer c on c.c_custkey = e.user_id)"""

LABELS_SQL = """
lab as (
  select t_id, cc_num, merchant_id,
         case when card_present then 'geo_fraud' else 'chain_attack' end as explanation, ts,
         ts + to_hours(cast(t_id % 72 as integer)) as label_available_ts
  from tx where label_is_fraud = 1)"""


def with_tx(body: str, *more: str) -> str:
    """SQL with the transaction view, and further CTEs, in front of it."""
    return "with " + ",".join([TX_SQL, *more]) + "\n" + body.strip()
