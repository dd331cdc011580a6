"""A baseline classifier: balanced, L2-regularised logistic regression in one ``pyspark.ml`` pipeline.

Imputation, scaling and encoding are stages of the saved model, so scoring applies what training learned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import require, split_by_type
from tidemark.operators.events import drop_unlabelled
from tidemark.operators.metrics import average_precision, roc_auc, run_summary
from tidemark.operators.prepare import (
    bounded,
    hash_split,
    medians,
    most_frequent,
    population_moments,
    stratified_split,
    with_class_weight,
)


@dataclass(frozen=True)
class TrainConfig:
    label: str = "label_is_fraud"
    row_id: str = "t_id"
    # Keys and times are not inputs: one-hot card numbers would give one column per card.
    exclude: tuple[str, ...] = ("event_ts", "ts", "cc_num", "merchant_id", "account_id")
    test_share: float = 0.2
    seed: int = 42
    stratified: bool = True
    c: float = 1.0
    max_iter: int = 500
    tol: float = 1e-4
    # Columns with more values than this are hashed into ``hash_buckets`` columns instead of having a column per value.
    max_categories: int = 1000
    hash_buckets: int = 4096
    # Rows used to fit at most, shared out among the classes by size; held-out rows are all scored.
    fit_rows: int | None = None
    provenance: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class TrainedModel:
    model: PipelineModel
    scored: DataFrame
    inputs: tuple[str, ...]
    n_fit: int


def limit_rows(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """At most ``cfg.fit_rows`` rows to fit on: of each class its share, at least one, by the hash of the row id."""
    return df if cfg.fit_rows is None else bounded(df, cfg.row_id, cfg.label, cfg.fit_rows, cfg.seed + 1)


def split(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    if cfg.stratified:
        return stratified_split(df, cfg.row_id, cfg.label, cfg.test_share, cfg.seed)
    return hash_split(df, cfg.row_id, 100 * cfg.test_share, cfg.seed, fine=True)


def _quoted(name: str) -> str:
    return f"`{name}`"


def _preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], wide: Sequence[str] = (), buckets: int = 1
) -> SQLTransformer:
    """Impute, scale and hash as one SQL projection with the learned numbers in it."""
    train = train.withColumns({c: F.col(c).cast("double") for c in numeric})
    middle = {c: m if m is not None else 0.0 for c, m in medians(train, numeric).items()}
    filled = train.withColumns({c: F.coalesce(F.col(c), F.lit(middle[c])) for c in numeric})
    moments = population_moments(filled, numeric).first() if numeric else None
    modes = most_frequent(train, categorical)
    columns = []
    for c in numeric:
        mean, std = moments[f"mean_{c}"] or 0.0, moments[f"std_{c}"] or 1.0
        filled_value = f"coalesce(cast({_quoted(c)} as double), {float(middle[c])!r}D)"
        columns.append(f"({filled_value} - ({float(mean)!r}D)) / {float(std)!r}D AS {_quoted('num_' + c)}")
    for c in categorical:
        mode = str(modes[c] if modes[c] is not None else "").replace("\\", "\\\\").replace("'", "\\'")
        columns.append(f"coalesce({_quoted(c)}, '{mode}') AS {_quoted('cat_' + c)}")
    for c in wide:
        # The hash of prepare.category_hash; a NULL is a value of its own here, as it has no mode to stand for it.
        digest = f"substr(md5(concat('{c}=', coalesce({_quoted(c)}, ''))), 1, 15)"
        columns.append(f"cast(pmod(cast(conv({digest}, 16, 10) as bigint), {buckets}L) as double) AS {_quoted('idx_' + c)}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def build_pipeline(train: DataFrame, cfg: TrainConfig) -> tuple[Pipeline, tuple[str, ...]]:
    numeric, categorical = split_by_type(
        train.drop("weight", "is_test"), {*cfg.exclude, cfg.label, cfg.row_id}
    )
    every = (*numeric, *categorical)
    wide = []
    if categorical:
        sizes = train.agg(*(F.approx_count_distinct(c).alias(c) for c in categorical)).first()
        wide = [c for c in categorical if sizes[c] > cfg.max_categories]
        categorical = [c for c in categorical if c not in wide]
    stages = [_preparation(train, numeric, categorical, wide, cfg.hash_buckets)]
    if wide:
        # Each column has buckets of its own. A bucket beyond the fitted ones was never seen and is all zeros.
        hashed = dict(inputCols=[f"idx_{c}" for c in wide], outputCols=[f"hot_{c}" for c in wide])
        stages.append(OneHotEncoder(**hashed, dropLast=True, handleInvalid="keep"))
    if categorical:
        # An unseen value gets the extra last index, which the encoder drops: all zeros.
        stages.append(
            StringIndexer(
                inputCols=[f"cat_{c}" for c in categorical],
                outputCols=[f"idx_{c}" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"idx_{c}" for c in categorical],
                outputCols=[f"hot_{c}" for c in categorical],
                dropLast=True,
            )
        )
    parts = [*(f"num_{c}" for c in numeric), *(f"hot_{c}" for c in categorical), *(f"hot_{c}" for c in wide)]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    # The penalty ||w||^2 / 2 + C * weighted loss, divided by C and the total weight (= rows).
    regularisation = 1.0 / (cfg.c * max(train.count(), 1))
    stages.append(
        LogisticRegression(
            featuresCol="features",
            labelCol=cfg.label,
            weightCol="weight",
            maxIter=cfg.max_iter,
            tol=cfg.tol,
            regParam=regularisation,
            elasticNetParam=0.0,
            standardization=False,
        )
    )
    return Pipeline(stages=stages), every


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Kept columns plus ``score``, the probability of the positive class."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def linear_score(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """The logistic score of given weights per numeric column, as an expression: no vectors, no model object. NULL counts as 0."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def optimum_gap(model: PipelineModel, fit_on: DataFrame, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """(position, coefficient, gradient): the slope of the penalised mean loss at the fitted weights, the intercept last.

    All slopes are 0 at the optimum, which a strictly convex loss has once, so this proves a fit right without a second
    solver. ``fit_on`` holds the rows and weights of the fit. Per class, Spark's summarizer adds up the feature vectors, weighed by how far
    the probability is off, so one pass with partial sums per task serves vectors of any width.
    """
    fitted = model.stages[-1]
    scored = model.transform(fit_on).select(
        "features", "weight", F.col(cfg.label).cast("int").alias("y"), vector_to_array("probability")[1].alias("p")
    )
    off = F.col("weight") * F.abs(F.col("p") - F.col("y"))
    sums = Summarizer.metrics("sum").summary(F.col("features"), off)["sum"]
    per_class = scored.groupBy("y").agg(vector_to_array(sums).alias("sums"), F.sum(off).alias("off"), F.sum("weight").alias("weight"))
    # Two rows from here on: class 0 pulls with its sums, class 1 against them.
    pull = F.when(F.col("y") == 0, 1.0).otherwise(-1.0)
    long = per_class.select("weight", pull.alias("pull"), F.posexplode(F.concat("sums", F.array("off"))).alias("position", "s"))
    slopes = long.groupBy("position").agg((F.sum(F.col("pull") * F.col("s")) / F.sum("weight")).alias("slope"))
    spark, penalty = fit_on.sparkSession, fitted.getRegParam()
    found = [(k, float(b), penalty * float(b)) for k, b in enumerate(fitted.coefficients.toArray())]
    found.append((len(found), float(fitted.intercept), 0.0))
    weights = spark.createDataFrame(found, "position int, coefficient double, pulled double")
    return weights.join(slopes, "position", "left").select(
        "position", "coefficient", (F.coalesce("slope", F.lit(0.0)) + F.col("pulled")).alias("gradient")
    )


def train(df: DataFrame, cfg: TrainConfig = TrainConfig()) -> TrainedModel:
    """Fit on the training part; ``scored`` has (row id, label, score) of the held-out part."""
    require(df, [cfg.label, cfg.row_id], "training set")
    known = drop_unlabelled(df, cfg.label)
    parts = split(known.withColumn(cfg.label, F.col(cfg.label).cast("int")), cfg)
    fit_on = limit_rows(parts.filter(~F.col("is_test")), cfg)
    n_fit = fit_on.count()
    fit_on = with_class_weight(fit_on, cfg.label)
    pipeline, inputs = build_pipeline(fit_on, cfg)
    model = pipeline.fit(fit_on)
    scored = score(model, parts.filter("is_test"), cfg.row_id, F.col(cfg.label).alias("label"))
    return TrainedModel(model, scored, inputs, n_fit)


def run_record(df: DataFrame, trained: TrainedModel, cfg: TrainConfig, run_id: str) -> DataFrame:
    """One row: parameters, metrics and where the data came from."""
    summary = run_summary(df, cfg.label)
    parts = [summary, roc_auc(trained.scored), average_precision(trained.scored)]
    keyed = [p.withColumn("run_id", F.lit(run_id)) for p in parts]
    row = keyed[0].join(keyed[1], "run_id").join(keyed[2], "run_id")
    settings = {f.name: getattr(cfg, f.name) for f in fields(cfg) if f.name != "provenance"}
    params = {name: str(value) for name, value in settings.items()} | {"inputs": ",".join(trained.inputs), "n_fit": str(trained.n_fit)}
    params |= cfg.provenance
    pairs = [F.lit(x) for kv in params.items() for x in kv]
    return row.withColumn("params", F.create_map(*pairs)).withColumn("logged_at", F.current_timestamp())
