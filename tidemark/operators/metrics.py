"""Ranking metrics and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import DEFAULT_TILES, TilePolicy, frequencies, totals_before


def roc_auc(
    scored: DataFrame, score: str = "score", label: str = "label", policy: TilePolicy = DEFAULT_TILES
) -> DataFrame:
    """One row ``roc_auc``: the share of (positive, negative) pairs ranked right, ties half.

    Counted from running totals over the distinct scores, without forming pairs. NaN for one class. Rows
    without a label do not count.
    """
    scored = scored.filter(F.col(label).isNotNull())
    groups = frequencies(scored, F.col(score), pos=F.col(label).cast("long"))
    groups = groups.withColumn("neg", F.col("n") - F.col("pos"))
    placed = totals_before(groups, ["neg"], policy=policy)
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.agg(F.when(pairs > 0, F.sum(won) / pairs).otherwise(F.lit(float("nan"))).alias("roc_auc"))


def average_precision(
    scored: DataFrame, score: str = "score", label: str = "label", policy: TilePolicy = DEFAULT_TILES
) -> DataFrame:
    """One row ``pr_auc``: precision at each distinct score, weighted by the recall it adds (a step
    function, not the trapezoids of ``areaUnderPR``). NaN for one class. Rows without a label do not count."""
    scored = scored.filter(F.col(label).isNotNull())
    groups = frequencies(scored, -F.col(score).cast("double"), pos=F.col(label).cast("long"))
    placed = totals_before(groups, ["pos", "n"], policy=policy)
    precision = (F.col("pos_before") + F.col("pos")).cast("double") / (F.col("n_before") + F.col("n"))
    positives, rows = F.sum("pos").cast("double"), F.sum("n")
    value = F.sum(F.col("pos") * precision) / positives
    return placed.agg(
        F.when((positives > 0) & (positives < rows), value).otherwise(F.lit(float("nan"))).alias("pr_auc")
    )


def run_summary(df: DataFrame, label: str = "label_is_fraud") -> DataFrame:
    """n_rows, n_pos, pos_rate of the rows that carry a label."""
    known = df.filter(F.col(label).isNotNull())
    return known.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label).cast("long")).alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"),
    )


def realised_rate(tx: DataFrame, labels: DataFrame, key: str = "t_id") -> DataFrame:
    """Labelled share of the events: distinct labelled ids over events."""
    n_labelled = labels.agg(F.count_distinct(key).alias("n_labelled"))
    n_tx = tx.agg(F.count(F.lit(1)).alias("n_tx"))
    # Two one-row results side by side, keyed to avoid a cartesian product.
    both = n_tx.withColumn("__one", F.lit(1)).join(n_labelled.withColumn("__one", F.lit(1)), "__one")
    rate = F.when(F.col("n_tx") > 0, F.col("n_labelled").cast("double") / F.col("n_tx")).otherwise(F.lit(0.0))
    return both.select("n_tx", "n_labelled", rate.alias("realised_rate"))
