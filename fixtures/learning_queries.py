"""Preparation, metrics and the baseline model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from fixtures.history_queries import card_states, merchant_states
from fixtures.registry import ORACLES, query
from fixtures.views import labels, table, tx, tx_geo, with_tx
from tidemark.operators import metrics, prepare
from tidemark.operators.model import TrainConfig, TrainedModel, build_pipeline, limit_rows, linear_score, optimum_gap, run_record, train
from tidemark.operators.ordered import TilePolicy
from tidemark.plans import silver, training
from tidemark.session import shared_dir
from tidemark.sources.lake import Lake, latest_versions

GAPPY_SQL = """
gappy as (select t_id, case when event_type <> 'view' then amount end as amount,
                 case when event_type <> 'click' then merchant_id end as merchant_id,
                 case when event_type <> 'click' then channel end as channel from tx)"""


def _gappy(spark, sf_dir):
    kind = F.col("event_type")
    return tx(spark, sf_dir).select(
        "t_id",
        F.when(kind != "view", F.col("amount")).alias("amount"),
        F.when(kind != "click", F.col("merchant_id")).alias("merchant_id"),
        F.when(kind != "click", F.col("channel")).alias("channel"),
    )


SCORED_SQL = """
scored as (select t_id, cast(amount as double) / (cast(amount as double) + 50) as score, label_is_fraud as label
           from tx)"""


def _scored(spark, sf_dir):
    amount = F.col("amount").cast("double")
    return tx(spark, sf_dir).select("t_id", (amount / (amount + 50)).alias("score"), F.col("label_is_fraud").alias("label"))


@query(
    "split_assign",
    with_tx(
        "select t_id, label_is_fraud, cast('0x' || substr(md5('42:' || cast(t_id as varchar)), 1, 15) as bigint) % 100 < 20 "
        "as is_test from tx"
    ),
)
def split_assign(spark, sf_dir):
    return prepare.hash_split(tx(spark, sf_dir).select("t_id", "label_is_fraud"), "t_id")


@query(
    "split_stratified",
    with_tx(
        "select t_id, label_is_fraud, row_number() over (partition by label_is_fraud order by h) "
        "<= floor(count(*) over (partition by label_is_fraud) * 0.2 + 0.5) as is_test from "
        "(select *, substr(md5('42:' || cast(t_id as varchar)), 1, 15) as h from tx)"
    ),
)
def split_stratified(spark, sf_dir):
    return prepare.stratified_split(tx(spark, sf_dir).select("t_id", "label_is_fraud"), "t_id", "label_is_fraud")


@query(
    "impute_median",
    with_tx(
        "select t_id, coalesce(cast(amount as double), (select quantile_cont(cast(amount as double), 0.5) from gappy)) "
        "as amount from gappy",
        GAPPY_SQL,
    ),
)
def impute_median(spark, sf_dir):
    return prepare.impute_median(_gappy(spark, sf_dir).select("t_id", "amount"), ["amount"])


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "medians_all",
    " union all ".join(
        f"select l_returnflag, '{c}' as \"column\", quantile_cont(cast({c} as double), 0.5) as median from lineitem group by 1" for c in NUMBERS
    ),
)
def medians_all(spark, sf_dir):
    return prepare.class_medians(table(spark, sf_dir, "lineitem"), NUMBERS, ["l_returnflag"])


@query(
    "limit_rows",
    with_tx(
        "select t_id, label_is_fraud from (select t_id, label_is_fraud, row_number() over (partition by label_is_fraud order by h) as rn, "
        "greatest(1, floor(count(*) over (partition by label_is_fraud) * 100.0 / count(*) over ())) as k from "
        "(select *, substr(md5('43:' || cast(t_id as varchar)), 1, 15) as h from tx)) where rn <= k"
    ),
)
def limited(spark, sf_dir):
    return limit_rows(tx(spark, sf_dir).select("t_id", "label_is_fraud"), TrainConfig(fit_rows=100))


@query(
    "impute_mode",
    with_tx(
        "select t_id, coalesce(channel, (select channel from gappy where channel is not null group by 1 "
        "order by count(*) desc, 1 limit 1)) as channel, coalesce(merchant_id, (select merchant_id from gappy "
        "where merchant_id is not null group by 1 order by count(*) desc, 1 limit 1)) as merchant_id from gappy",
        GAPPY_SQL,
    ),
)
def impute_mode(spark, sf_dir):
    return prepare.impute_mode(_gappy(spark, sf_dir).drop("amount"), ["channel", "merchant_id"])


@query(
    "zscore",
    with_tx(
        "select t_id, round((cast(amount as double) - avg(cast(amount as double)) over ()) / "
        "stddev_pop(cast(amount as double)) over (), 6) as amount_z from tx"
    ),
)
def zscore(spark, sf_dir):
    scaled = prepare.standardise(tx(spark, sf_dir).select("t_id", "amount"), ["amount"])
    return scaled.select("t_id", F.round("amount_z", 6).alias("amount_z"))


ONE_HOT_SQL = ", ".join(f"cast(coalesce(event_type = '{v}', false) as integer) as event_type_{v}" for v in ["click", "error", "view"])


@query("onehot", with_tx(f"select t_id, {ONE_HOT_SQL} from tx"))
def onehot(spark, sf_dir):
    return prepare.one_hot(tx(spark, sf_dir).select("t_id", "event_type"), "event_type", ["click", "error", "view"]).drop(
        "event_type"
    )


@query(
    "class_weights",
    with_tx(
        "select label_is_fraud, n, sum(n) over () / cast(count(*) over () * n as double) as weight "
        "from (select label_is_fraud, count(*) as n from tx group by 1)"
    ),
)
def class_weights(spark, sf_dir):
    return prepare.class_weights(tx(spark, sf_dir), "label_is_fraud")


@query(
    "roc_auc",
    with_tx(
        "select round(sum(pos * (neg_upto - neg + neg / 2.0)) / (sum(pos) * cast(sum(neg) as double)), 6) as roc_auc from ("
        "select *, sum(neg) over (order by score) as neg_upto from ("
        "select score, cast(sum(label) as double) as pos, cast(count(*) - sum(label) as double) as neg from scored group by 1))",
        SCORED_SQL,
    ),
)
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scored(spark, sf_dir)).select(F.round("roc_auc", 6).alias("roc_auc"))


@query("roc_auc_tiled", ORACLES["roc_auc"])
def roc_auc_tiled(spark, sf_dir):
    policy = TilePolicy(10, 20)
    return metrics.roc_auc(_scored(spark, sf_dir), policy=policy).select(F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "avg_precision",
    with_tx(
        "select round(sum(pos * tp / k) / sum(pos), 6) as pr_auc from ("
        "select pos, sum(pos) over w as tp, sum(n) over w as k from ("
        "select score, cast(sum(label) as double) as pos, cast(count(*) as double) as n from scored group by 1) "
        "window w as (order by score desc))",
        SCORED_SQL,
    ),
)
def avg_precision(spark, sf_dir):
    return metrics.average_precision(_scored(spark, sf_dir)).select(F.round("pr_auc", 6).alias("pr_auc"))


HASHED, BUCKETS = ["channel", "merchant_id", "category", "event_type"], 64


def _digest(name: str, value: str) -> str:
    return f"cast('0x' || substr(md5('{name}=' || cast({value} as varchar)), 1, 15) as bigint)"


@query(
    "hashed_features",
    with_tx(
        "select t_id, cast((h >> 1) % 64 as integer) as bucket, cast(sum(case when h % 2 = 0 then 1 else -1 end) as integer) as value "
        "from entries where h is not null group by 1, 2 having sum(case when h % 2 = 0 then 1 else -1 end) <> 0",
        "entries as (" + " union all ".join(f"select t_id, {_digest(c, c)} as h from tx" for c in HASHED) + ")",
    ),
)
def hashed_features(spark, sf_dir):
    return prepare.hashed_features(tx(spark, sf_dir), ["t_id"], HASHED, BUCKETS)


WEIGHTS = {"l_quantity": -0.05, "l_discount": 12.5, "l_tax": -3.0, "l_extendedprice": 0.00001}


@query(
    "score_fixed",
    "select l_orderkey, l_linenumber, round(1 / (1 + exp(-(0.25"
    + "".join(f" + {w} * coalesce(cast({c} as double), 0)" for c, w in WEIGHTS.items())
    + "))), 6) as score from lineitem",
)
def score_fixed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(linear_score(WEIGHTS, 0.25), 6).alias("score"))


@query(
    "fit_optimum",
    with_tx(
        "select 4 + count(distinct channel) + (select max(" + _digest("merchant_id", "merchant_id") + " % 16) + 1 from tx) + 1 as n_coefficients, "
        "cast(0 as double) as gradient from tx"
    ),
)
def fit_optimum(spark, sf_dir):
    """The largest slope of the loss at the fitted weights: 0 to four places. Merchants are hashed, channels have a column each."""
    path = shared_dir(spark, "fit")
    inputs = ["amount", "lat", "lon", "card_present", "channel", F.col("merchant_id").cast("string").alias("merchant_id")]
    tx(spark, sf_dir).select("t_id", "label_is_fraud", *inputs).write.parquet(path)
    cfg = TrainConfig(exclude=(), tol=1e-10, max_categories=3, hash_buckets=16)
    fit_on = prepare.with_class_weight(spark.read.parquet(path), cfg.label)
    pipeline, _ = build_pipeline(fit_on, cfg)
    found = optimum_gap(pipeline.fit(fit_on), fit_on, cfg)
    return found.agg(F.count("*").alias("n_coefficients"), F.round(F.max(F.abs("gradient")), 4).alias("gradient"))


@query(
    "run_record",
    "select 'r1' as run_id, n_rows, n_pos, roc_auc, pr_auc, '0.2' as test_share from "
    f"({with_tx('select count(*) as n_rows, cast(sum(label_is_fraud) as bigint) as n_pos from tx')}), ({ORACLES['roc_auc']}), ({ORACLES['avg_precision']})",
)
def recorded(spark, sf_dir):
    """The record of a run over given scores, published and read back."""
    lake = Lake(spark, shared_dir(spark, "lake"))
    record = run_record(tx(spark, sf_dir), TrainedModel(None, _scored(spark, sf_dir), (), 0), TrainConfig(), "r1")
    lake.publish(record, "runs", "2024-01-30", "r1")
    rounded = [F.round(c, 6).alias(c) for c in ("roc_auc", "pr_auc")]
    return lake.read("runs").select("run_id", "n_rows", "n_pos", *rounded, F.col("params")["test_share"].alias("test_share"))


@query(
    "model_alias",
    with_tx("select 'models/imputer@current' as dataset, 'models/imputer/dt=' || max(strftime(ts, '%Y-%m-%d')) || '/run_id=r1' as prefix from tx"),
)
def model_alias(spark, sf_dir):
    """An alias moved from the model of the first day to that of the last."""
    events = tx(spark, sf_dir)
    first, last = events.agg(F.date_format(F.min("ts"), "yyyy-MM-dd"), F.date_format(F.max("ts"), "yyyy-MM-dd")).first()
    lake = Lake(spark, shared_dir(spark, "lake"))
    for day in (first, last):
        before = events.filter(F.date_format("ts", "yyyy-MM-dd") <= day).select(F.col("amount").cast("double").alias("amount"))
        lake.save_model(Pipeline(stages=[Imputer(inputCol="amount", outputCol="filled")]).fit(before), "imputer", day, "r1")
        lake.set_alias("imputer", "current", day, "r1")
    return latest_versions(lake.manifest().filter("kind = 'alias'"), ["dataset"]).select("dataset", "prefix")


@query("fit_score")
def fit_score(spark, sf_dir):
    """Held-out scores of the baseline model on the point-in-time training set."""
    events, known = tx_geo(spark, sf_dir), labels(spark, sf_dir)
    events = events.withColumns({c: F.col(c).cast("string") for c in ("country", "category")})
    card = silver.card_history(card_states(spark, sf_dir))
    merchant = silver.merchant_history(merchant_states(spark, sf_dir))
    df = training.training_set(events, known, card, merchant, tie=("t_id",))
    # Training passes over the set many times: it is written once and read back.
    lake = Lake(spark, shared_dir(spark, "lake"))
    lake.publish(df, "silver/training_set", "2024-01-30", "r1")
    df = lake.read("silver/training_set")
    return train(df, TrainConfig()).scored.withColumn("score", F.round("score", 4))
