"""Profiles of the feature table and of tables with repeated keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.history_queries import FEATURES_SQL
from fixtures.registry import query
from fixtures.views import LABELS_SQL, labels, table, tx, tx_geo, with_tx
from tidemark.operators import metrics, ordered, profile
from tidemark.operators.events import drop_unlabelled
from tidemark.plans import silver
from tidemark.session import shared_dir


def _features(spark, sf_dir):
    return silver.transaction_features(tx_geo(spark, sf_dir).drop("label_is_fraud"), labels(spark, sf_dir))


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "profile_shape",
    "select count(*) as n_rows, cast(6 as integer) as n_cols, min(ts) as min_ts, max(ts) as max_ts from events",
)
def profile_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "events"), "ts")


@query("label_dist", with_tx("select label_is_fraud, count(*) as n from tx group by 1"))
def label_dist(spark, sf_dir):
    return profile.label_distribution(tx(spark, sf_dir), "label_is_fraud")


@query(
    "distinct_keys",
    with_tx(
        "select count(distinct t_id) as n_t_id, count(distinct cc_num) as n_cc_num, "
        "count(distinct merchant_id) as n_merchant_id from tx"
    ),
)
def distinct_keys(spark, sf_dir):
    return profile.distinct_keys(tx(spark, sf_dir), ["t_id", "cc_num", "merchant_id"])


@query(
    "dup_keys",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def dup_keys(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dup_rows",
    "select cast(sum(n - 1) as bigint) as duplicate_rows from "
    "(select count(*) as n from lineitem group by l_orderkey, l_linenumber)",
)
def dup_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


NULL_PARTS = " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_null, count(*) as n_rows from feat"
    for c in silver.FEATURE_COLUMNS
)


@query(
    "null_profile",
    with_tx(
        "select column_name, n_null, n_rows, round(n_null / cast(n_rows as double) * 100, 6) as pct_null "
        f"from ({NULL_PARTS}) order by n_null desc, column_name limit 20",
        FEATURES_SQL,
    ),
)
def null_profile(spark, sf_dir):
    return _rounded(profile.null_profile(_features(spark, sf_dir)), "pct_null")


@query(
    "null_profile_all",
    with_tx(
        "select column_name, n_null, n_rows, round(n_null / cast(n_rows as double) * 100, 6) as pct_null "
        f"from ({NULL_PARTS})",
        FEATURES_SQL,
    ),
)
def null_profile_all(spark, sf_dir):
    return _rounded(profile.null_profile(_features(spark, sf_dir), top=None), "pct_null")


@query(
    "coverage",
    with_tx(
        "select count(*) as n_rows, count(cc_time_since_last_s) as card_covered, count(m_fraud_cnt_1d) as m_covered "
        "from feat",
        FEATURES_SQL,
    ),
)
def coverage(spark, sf_dir):
    return profile.coverage(_features(spark, sf_dir), {"card": "cc_time_since_last_s", "m": "m_fraud_cnt_1d"})


@query(
    "num_stats",
    with_tx(
        "select count(amount) as n, round(avg(cast(amount as double)), 6) as mean, "
        "round(stddev_samp(cast(amount as double)), 6) as std, cast(min(amount) as double) as min, "
        "cast(max(amount) as double) as max from tx"
    ),
)
def num_stats(spark, sf_dir):
    return _rounded(profile.numeric_summary(tx(spark, sf_dir), "amount"), "mean", "std")


@query(
    "percentiles",
    with_tx(
        "select round(quantile_cont(cast(amount as double), 0.5), 6) as p50, "
        "round(quantile_cont(cast(amount as double), 0.9), 6) as p90 from tx"
    ),
)
def percentiles(spark, sf_dir):
    return _rounded(ordered.quantiles(tx(spark, sf_dir), "amount", {"p50": 0.5, "p90": 0.9}), "p50", "p90")


@query("percentiles_approx")
def percentiles_approx(spark, sf_dir):
    return profile.approximate_percentiles(tx(spark, sf_dir), "amount", {"p50": 0.5, "p90": 0.9})


@query(
    "leakage_probe",
    with_tx(
        "select label_is_fraud, round(avg(cast(m_fraud_cnt_1d as double)), 6) as mean_m_fraud_cnt_1d from feat "
        "group by 1",
        FEATURES_SQL,
    ),
)
def leakage_probe(spark, sf_dir):
    means = profile.group_mean(_features(spark, sf_dir), "label_is_fraud", "m_fraud_cnt_1d", "mean_m_fraud_cnt_1d")
    return _rounded(means, "mean_m_fraud_cnt_1d")


@query(
    "sample_by_label",
    with_tx(
        "select t_id, ts, cc_num, merchant_id, amount, channel, card_present, label_is_fraud from "
        "(select *, row_number() over (partition by label_is_fraud order by t_id) as rn from tx) where rn <= 5"
    ),
)
def sample_by_label(spark, sf_dir):
    columns = ["t_id", "ts", "cc_num", "merchant_id", "amount", "channel", "card_present", "label_is_fraud"]
    return profile.sample_per_group(tx(spark, sf_dir).select(*columns), "label_is_fraud", ["t_id"])


@query(
    "preview",
    "select *, (select count(*) from events) as n_records from events order by event_id limit 3",
)
def preview(spark, sf_dir):
    return profile.preview(table(spark, sf_dir, "events"), ["event_id"])


@query(
    "run_summary",
    with_tx(
        "select count(*) as n_rows, cast(sum(label_is_fraud) as bigint) as n_pos, "
        "round(avg(cast(label_is_fraud as double)), 9) as pos_rate from tx"
    ),
)
def run_summary(spark, sf_dir):
    return _rounded(metrics.run_summary(tx(spark, sf_dir)), "pos_rate", digits=9)


@query(
    "realised_rate",
    with_tx(
        "select (select count(*) from tx) as n_tx, count(distinct t_id) as n_labelled, "
        "round(count(distinct t_id) / cast((select count(*) from tx) as double), 9) as realised_rate from lab",
        LABELS_SQL,
    ),
)
def realised_rate(spark, sf_dir):
    return _rounded(metrics.realised_rate(tx(spark, sf_dir), labels(spark, sf_dir)), "realised_rate", digits=9)


@query("drop_null_label", "select d.doc_id, l.toxic from documents d join labels l using (doc_id)")
def drop_null_label(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    marked = docs.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return drop_unlabelled(marked, "toxic")


@query("distinct_sketch", "select event_type, count(*) as n_rows, true as users_within, true as values_within from events group by 1")
def distinct_sketch(spark, sf_dir):
    """Distinct counts per event type from sketches stored per day, held against exact counts: within 5 %."""
    events = table(spark, sf_dir, "events")
    path = shared_dir(spark, "sketches")
    profile.sketches(events.withColumn("day", F.to_date("ts")), ["day", "event_type"], ["user_id", "event_id"]).write.parquet(path)
    merged = profile.merge_sketches(spark.read.parquet(path), ["event_type"])
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_id").alias("ids"))
    near = lambda column, n: F.abs(profile.distinct_estimate(column) - F.col(n)) <= 0.05 * F.col(n)
    both = merged.join(exact, merged["event_type"].eqNullSafe(exact["event_type"])).drop(exact["event_type"])
    return both.select("event_type", "n_rows", near("user_id", "users").alias("users_within"), near("event_id", "ids").alias("values_within"))


@query(
    "percentile_rank_error",
    "select l_returnflag, count(*) as n_rows, true as p50_within, true as p90_within, true as p99_within from lineitem group by 1",
)
def percentile_rank_error(spark, sf_dir):
    """Percentiles per return flag from sketches stored per month: the rank of each, counted exactly, is within 0.5 % of the rows."""
    items = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "sketches")
    by_month = items.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    profile.sketches(by_month, ["l_returnflag", "month"], numeric=["l_extendedprice"]).write.parquet(path)
    shares = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    merged = profile.merge_sketches(spark.read.parquet(path), ["l_returnflag"])
    found = merged.select("l_returnflag", *(profile.quantile_estimate("l_extendedprice", p).alias(n) for n, p in shares.items()))
    value = F.col("l_extendedprice").cast("double")
    counts = [c for n in shares for c in (F.count_if(value < F.col(n)).alias(f"below_{n}"), F.count_if(value <= F.col(n)).alias(f"upto_{n}"))]
    ranked = items.join(found, "l_returnflag").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    within = lambda n, p: (F.col(f"below_{n}") <= (p + 0.005) * F.col("n_rows")) & (F.col(f"upto_{n}") >= (p - 0.005) * F.col("n_rows"))
    return ranked.select("l_returnflag", "n_rows", *(within(n, p).alias(f"{n}_within") for n, p in shares.items()))
