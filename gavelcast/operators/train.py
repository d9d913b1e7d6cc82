"""Regressors on log price, early stopping, and the training loop."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..params import BOOSTING_PARAMS, PATIENCE, RIDGE_PARAMS, SEED
from . import conjugate, evaluate
from .boosting import FEATURES, LABEL, Boosting, patience_rule

# Settings of leaf-wise or penalised trees, which MLlib's level-wise trees do not have.
UNSUPPORTED = ("reg_alpha", "reg_lambda", "num_leaves")
DEEPEST = 30
# MLlib's normal solver refuses more.
NORMAL_FEATURES = 4096
# Most rounds between two looks at the validation error.
CHECKED = 16

# Published settings as far as MLlib has them. A level-wise tree of at most 137 leaves is
# one of depth 7, so the published depth of 15, which the leaves bound there, becomes 7.
BOOSTING_DEFAULTS = {
    **{k: v for k, v in BOOSTING_PARAMS.items() if k not in UNSUPPORTED},
    "max_depth": int(math.log2(BOOSTING_PARAMS["num_leaves"])), "max_bins": 64,
}


@dataclass
class Fitted:
    """A trained regressor on the log scale."""

    key: str
    model: Model
    features: list[str]
    seconds: float = 0.0
    curve: DataFrame | None = None
    best_iteration: int | None = None
    stopped_early: bool = False

    def predict(self, df: DataFrame, column: str) -> DataFrame:
        """Add the log-scale prediction to rows that carry the assembled features."""
        model = self.model.copy()
        model.setPredictionCol(column)
        return model.transform(df)

    def stages(self) -> PipelineModel:
        """Assembler, unless the features come as a vector, and regressor as one saveable transformer."""
        return PipelineModel(stages=[*([assembler(self.features)] if self.features else []), self.model])


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def assemble(df: DataFrame, features: Sequence[str], label: str, carry: Sequence[str] = ()):
    """``(features, label, *carry)`` rows; rows without a label are left out."""
    rows = assembler(features).transform(df.where(F.col(label).isNotNull()))
    return rows.select(FEATURES, F.col(label).cast("double").alias(LABEL), *carry)


def feature_count(train: DataFrame) -> int:
    """Length of the feature vectors."""
    first = train.select(FEATURES).first()
    return first[0].size if first else 0


def ridge(
    train: DataFrame, features: Sequence[str], alpha: float = RIDGE_PARAMS["alpha"]
) -> Fitted:
    """Least squares with an ``alpha * |w|^2`` penalty; the intercept is free.

    MLlib scales the label and averages the loss, so its ``regParam`` is
    ``alpha * std(label) / n``. Normal equations need one pass over the rows, but a square of the
    features on the driver; beyond ``NORMAL_FEATURES`` of them conjugate gradients take over.
    """
    start = time.time()
    if feature_count(train) > NORMAL_FEATURES:
        model = conjugate.ridge(train, FEATURES, LABEL, alpha)
        return Fitted("ridge", model, list(features), time.time() - start)
    stats = train.agg(F.count(LABEL).alias("n"), F.stddev_pop(LABEL).alias("sd")).first()
    regressor = LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, solver="normal", standardization=False,
        elasticNetParam=0.0, regParam=alpha * (stats["sd"] or 0.0) / max(stats["n"], 1))
    model = regressor.fit(train)
    return Fitted("ridge", model, list(features), time.time() - start)


def boosting_arguments(params: dict) -> dict:
    """MLlib arguments from boosting settings.

    MLlib fits each tree to the gradient of the squared error, twice the residual,
    so half the learning rate takes the same step. Settings without a counterpart and
    depths beyond MLlib's limit raise instead of being ignored or changed.
    """
    params = {k: v for k, v in params.items() if v is not None}
    for name in UNSUPPORTED:
        if params.pop(name, 0):
            raise ValueError(f"{name} has no counterpart in MLlib boosting")
    depth = params.pop("max_depth", 5)
    if not 1 <= depth <= DEEPEST:
        raise ValueError(f"max_depth must lie between 1 and {DEEPEST}")
    columns = params.pop("colsample_bytree", 1.0)
    out = {
        "maxIter": params.pop("n_estimators", 20),
        "stepSize": params.pop("learning_rate", 0.1) / 2,
        "maxDepth": depth,
        "minInstancesPerNode": params.pop("min_child_samples", 1),
        "subsamplingRate": params.pop("subsample", 1.0),
        "featureSubsetStrategy": "all" if columns >= 1.0 else str(columns),
        "seed": params.pop("seed", SEED),
        "maxBins": params.pop("max_bins", BOOSTING_DEFAULTS["max_bins"]),
    }
    if params:
        raise ValueError(f"unknown boosting settings: {sorted(params)}")
    return out


def learning_curve(spark: SparkSession, errors: Sequence[float], run: str) -> DataFrame:
    """``(model, iteration, rmse)`` on the log scale, one row per round."""
    schema = T.StructType([
        T.StructField("model", T.StringType()), T.StructField("iteration", T.IntegerType()),
        T.StructField("rmse", T.DoubleType())])
    return spark.createDataFrame([(run, i, float(e)) for i, e in enumerate(errors, 1)], schema)


def best_iteration(curve: DataFrame, patience: int, by: Sequence[str] = ("model",)) -> DataFrame:
    """Apply the patience rule to each curve: ``(*by, best_iteration, best_rmse, last, stopped)``.

    A curve ends at the first round that is ``patience`` rounds past its best;
    what comes later does not count. A curve has one row per boosting round, so a
    window over it is small whatever the data.
    """
    order = Window.partitionBy(*by).orderBy("iteration")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    record = F.col("rmse") < F.coalesce(F.min("rmse").over(before), F.lit(float("inf")))
    marked = curve.withColumn("__record", record).withColumn(
        "__best", F.last(F.when(F.col("__record"), F.col("iteration")), ignorenulls=True).over(upto))
    marked = marked.withColumn(
        "__over", (F.col("iteration") - F.col("__best") >= patience).cast("int"))
    marked = marked.withColumn("__ended", F.coalesce(F.max("__over").over(before), F.lit(0)))
    counted = marked.where(F.col("__ended") == 0)
    return counted.groupBy(*by).agg(
        F.max("__best").alias("best_iteration"),
        F.min(F.when(F.col("__record"), F.col("rmse"))).alias("best_rmse"),
        F.max("iteration").alias("last"),
        F.max("__over").alias("stopped"),
    )


def boosted_trees(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    params: dict | None = None,
    patience: int = PATIENCE,
    block: int | None = None,
    key: str = "boosted_trees",
    warm: GBTRegressionModel | None = None,
) -> Fitted:
    """Boost until validation RMSE has not improved for ``patience`` rounds, or to the cap ``n_estimators``.

    The rule is checked every ``CHECKED`` rounds or as soon as it may end the run, so a high cap costs nothing; ``block``
    checks every so many rounds instead. The winner is the first trees of the run; nothing is fitted again. With ``warm``
    the rounds continue that model, and rounds count from it.
    """
    start = time.time()
    arguments = boosting_arguments({**BOOSTING_DEFAULTS, **(params or {})})
    cap = arguments.pop("maxIter")
    run = Boosting(train, validation, [arguments], warm=warm)
    while True:
        done = len(run.errors[0])
        at = patience_rule(run.errors[0], patience)[0]
        # The rule cannot end the run before the patience since its best round has passed.
        rounds = max(1, min(block or CHECKED, patience - (done - at)))
        if not done and block:
            rounds = block
        rounds = min(rounds, cap - done)
        run.advance([0], rounds, last=done + rounds >= cap)
        best, _, last, stopped = patience_rule(run.errors[0], patience)
        if stopped or len(run.errors[0]) >= cap:
            break
    run.close()
    return Fitted(key, run.model(0, best), list(features), time.time() - start,
                  learning_curve(train.sparkSession, run.errors[0][:last], key), best, stopped)


Trainer = Callable[[DataFrame, DataFrame, Sequence[str], dict], Fitted]


def _train_ridge(train, validation, features, params):
    return ridge(train, features, **params)


def _train_boosted(train, validation, features, params):
    params = dict(params)
    patience = params.pop("patience", PATIENCE)
    return boosted_trees(train, validation, features, params, patience)


# Model key -> trainer. Add an entry to train another kind of model.
TRAINERS: dict[str, Trainer] = {"ridge": _train_ridge, "boosted_trees": _train_boosted}
MODELS: dict[str, dict] = {"ridge": dict(RIDGE_PARAMS), "boosted_trees": {}}
MODEL_NAMES = {"ridge": "Ridge Regression", "boosted_trees": "Boosted Trees"}


def train_one(key, train, validation, features, params) -> Fitted:
    if key not in TRAINERS:
        raise NotImplementedError(f"no trainer for {key!r}; known: {sorted(TRAINERS)}")
    return TRAINERS[key](train, validation, features, params)


@dataclass
class TrainingRun:
    """Models by key, with validation results ``(model, MAE, RMSE, R2, MAPE, train_seconds)``."""

    models: dict[str, Fitted] = field(default_factory=dict)
    results: DataFrame | None = None

    def best(self, metric: str = evaluate.MODEL_METRIC) -> Fitted:
        if not self.models:
            raise RuntimeError("no model has been trained")
        return self.models[evaluate.best_model_key(self.results, metric)]

    def leaderboard(self, metric: str = evaluate.MODEL_METRIC) -> DataFrame:
        """Validation results with display names and training times, best first."""
        names = F.create_map(*[F.lit(part) for pair in MODEL_NAMES.items() for part in pair])
        ranked = evaluate.leaderboard(self.results, metric)
        return ranked.withColumn("name", F.coalesce(F.try_element_at(names, "model"), "model"))

    def importance(self, spark: SparkSession, key: str, top_n: int = 20) -> DataFrame | None:
        """Top features of one model; ``None`` for an unknown model or one without weights."""
        fitted = self.models.get(key)
        return fitted and evaluate.feature_importance(spark, fitted.model, fitted.features, top_n)


def predict_all(
    models: dict[str, Fitted], df: DataFrame, y: str, carry: Sequence[str] = ()
) -> DataFrame:
    """``(*carry, model, y, prediction)`` of all models from one scan, original scale."""
    columns = {key: f"__log_{i}" for i, key in enumerate(models)}
    for key, fitted in models.items():
        df = fitted.predict(df, columns[key])
    return evaluate.long_predictions(df, columns, y, carry)


def train_all(
    train: DataFrame, validation: DataFrame, features: Sequence[str], y: str = "y",
    models: dict[str, dict] | None = None,
) -> TrainingRun:
    """Train every configured model and score it on the validation rows.

    ``validation`` carries the target on the original scale as ``y``.
    """
    run = TrainingRun()
    configured = MODELS if models is None else models
    for key, params in configured.items():
        run.models[key] = train_one(key, train, validation, features, params)
    if not run.models:
        return run
    spark = train.sparkSession
    scores = evaluate.compare(predict_all(run.models, validation, y)).collect()
    rows = [(r["model"], r["MAE"], r["RMSE"], r["R2"], r["MAPE"], run.models[r["model"]].seconds)
            for r in scores]
    run.results = spark.createDataFrame(
        rows, "model string, MAE double, RMSE double, R2 double, MAPE double, train_seconds double")
    return run


