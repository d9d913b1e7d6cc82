"""The end-to-end run: sales table in, models, error tables and artifacts out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import c, log_target, to_original_scale, without_nan
from ..operators import evaluate, plotdata, train, tune
from ..operators.features import engineer
from ..operators.preprocess import Preprocessor
from ..operators.schema import drop_columns
from ..operators.split import exact_split, hash_split
from ..params import Settings
from ..runtime import materialize
from ..sources import artifacts, csv

SPLITS = ("train", "val", "test")
SEARCHES = {"random": tune.random_search, "halving": tune.halving_search, "parzen": tune.parzen_search}


def load_and_split(
    spark: SparkSession, path: str, settings: Settings | None = None, exact: bool = False
) -> dict[str, DataFrame]:
    """Read, engineer and split a CSV: one frame per split."""
    return splits(prepare(csv.read_sales(spark, path), settings, exact))


def prepare(
    df: DataFrame, settings: Settings | None = None, exact: bool = False, keep: Sequence[str] | None = None
) -> DataFrame:
    """Engineered rows with a ``split`` column, stored once, one folder per split.

    With ``keep``, the columns that the preprocessor drops are dropped before they are stored, but for those named.
    """
    s = settings or Settings()
    divide = exact_split if exact else hash_split
    ready = divide(engineer(without_nan(df), s), s.split_key, s.split_ratios, s.seed)
    if keep is not None:
        ready = drop_columns(ready, s.dropped, (*s.target_encoded, *s.one_hot), (*keep, s.target, s.group, "split"))
    return materialize(ready, "prepared", "split")


def splits(prepared: DataFrame) -> dict[str, DataFrame]:
    return {name: prepared.where(F.col("split") == name).drop("split") for name in SPLITS}


@dataclass
class Outcome:
    preprocessor: Preprocessor
    run: train.TrainingRun
    scores: DataFrame
    segments: DataFrame
    summary: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run(
    df: DataFrame,
    settings: Settings | None = None,
    models: dict[str, dict] | None = None,
    output: str | None = None,
    with_tables: bool = True,
    exact: bool = False,
) -> Outcome:
    """Fit on train, choose on validation, report on test. ``exact`` gives the splits their exact sizes."""
    s = settings or Settings()
    prepared = prepare(df, s, exact)
    parts = splits(prepared)
    prep = Preprocessor(s).fit(parts["train"])
    features = () if prep.wide else prep.final_columns

    fit_rows = training_rows(prep, parts).persist(StorageLevel.MEMORY_AND_DISK)
    judged = evaluation_rows(prep, parts).persist(StorageLevel.MEMORY_AND_DISK)
    validation = judged.where(F.col("split") == "val")

    done = train.train_all(fit_rows, validation, features, "y", models)
    best = done.best()
    spark = df.sparkSession
    predictions = materialize(
        train.predict_all(done.models, judged, "y", ["split"]), "predictions", "split")
    scores = evaluate.metrics(predictions, ["split", "model"])
    on_test = predictions.where(F.col("split") == "test")
    chosen_val = predictions.where((F.col("split") == "val") & (F.col("model") == best.key))
    result = Outcome(
        prep, done, scores.orderBy("split", F.desc("R2")),
        evaluate.by_quantile(chosen_val), evaluate.summary(scores))
    if with_tables:
        importance = evaluate.feature_importance(spark, best.model, prep.feature_names(spark))
        result.tables = plotdata.all_tables(prepared, s.target, on_test, best.key, importance)
    if output:
        save(spark, result, output)
    fit_rows.unpersist()
    judged.unpersist()
    return result


def training_rows(prep: Preprocessor, parts: dict[str, DataFrame]) -> DataFrame:
    return _labelled(prep, prep.vectors(parts["train"], is_train=True, output=train.FEATURES), prep.settings.log_target)


def evaluation_rows(prep: Preprocessor, parts: dict[str, DataFrame]) -> DataFrame:
    """Validation and test rows with the untouched target as ``y``."""
    s = prep.settings
    sides = [parts[name].withColumn("split", F.lit(name)) for name in ("val", "test")]
    rows = prep.vectors(sides[0].unionByName(sides[1]), keep=["split"], output=train.FEATURES)
    rows = rows.withColumn("__log", log_target(c(s.target)))
    y = c(s.target).cast("double").alias("y")
    return _labelled(prep, rows, "__log", [y, "split"])


def _labelled(prep: Preprocessor, rows: DataFrame, label: str, carry: Sequence = ()) -> DataFrame:
    """``(features, label, *carry)``; rows without a label are left out."""
    known = rows.where(c(label).isNotNull())
    return known.select(train.FEATURES, c(label).cast("double").alias(train.LABEL), *carry)


def save(spark: SparkSession, outcome: Outcome, output: str) -> None:
    """Reports as CSV, model and preprocessor ready for scoring."""
    for split in ("val", "test"):
        board = evaluate.leaderboard(outcome.scores.where(F.col("split") == split))
        board = board.drop("split").withColumnRenamed("model", "Model")
        csv.write_report(board, f"{output}/reports/{split}_evaluation")
    csv.write_report(outcome.run.leaderboard().withColumnRenamed("model", "Model"), f"{output}/reports/leaderboard")
    for name, rows in outcome.tables.items():
        csv.write_report(rows, f"{output}/tables/{name}")
    artifacts.save_best(spark, outcome.run, f"{output}/best_model")
    artifacts.save_preprocessor(spark, outcome.preprocessor, f"{output}/preprocessor")


def tune_boosting(
    df: DataFrame, settings: Settings | None = None, output: str | None = None, exact: bool = False,
    method: str = "random", **search
) -> tuple[DataFrame, DataFrame]:
    """Search boosting settings on the validation rows: all trials, and the best one.

    ``method`` is a name of ``SEARCHES``; what else is given goes to that function.
    """
    parts = splits(prepare(df, settings, exact, keep=()))
    prep = Preprocessor(settings).fit(parts["train"])
    fit_rows = training_rows(prep, parts).persist(StorageLevel.MEMORY_AND_DISK)
    judged = evaluation_rows(prep, parts).where(F.col("split") == "val")
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    trials = SEARCHES[method](fit_rows, judged, () if prep.wide else prep.final_columns, **search)
    best = tune.best_trial(trials)
    if output:
        artifacts.save_params(best, f"{output}/best_params")
    fit_rows.unpersist()
    judged.unpersist()
    return trials, best


def score(
    df: DataFrame, preprocessor_path: str, model_path: str, keep: Sequence[str] = (),
    column: str = "predicted_price",
) -> DataFrame:
    """Price raw rows with saved artifacts: ``(*keep, predicted_price)``, lazily."""
    spark = df.sparkSession
    prep = artifacts.load_preprocessor(spark, preprocessor_path)
    model, _ = artifacts.load_best(spark, model_path)
    raw = engineer(without_nan(df), prep.settings)
    # The model of a wide preprocessor takes its vectors, any other the columns they are made of.
    rows = prep.vectors(raw, keep=keep, output=train.FEATURES) if prep.wide else prep.transform(raw, keep=keep)
    predicted = model.transform(rows)
    return predicted.select(*[c(n) for n in keep],
                            to_original_scale(F.col("prediction")).alias(column))
