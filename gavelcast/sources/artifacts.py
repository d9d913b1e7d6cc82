"""Fitted state on disk: parquet tables, MLlib models and one-row JSON."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from dataclasses import asdict, fields

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import sparse
from ..operators.encode import OneHot, target_encoding
from ..operators.impute import Medians, measured
from ..operators.preprocess import Preprocessor
from ..operators.train import MODEL_NAMES, TrainingRun
from ..params import MODEL_METRIC, Settings


def _write_json(spark: SparkSession, value: dict, path: str) -> None:
    table = spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string")
    table.coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def save_preprocessor(spark: SparkSession, prep: Preprocessor, path: str) -> str:
    if not prep.fitted:
        raise RuntimeError("fit the preprocessor first")
    medians, encoding = prep.medians, prep.target_encoding
    _write_json(spark, {
        "settings": asdict(prep.settings),
        "sources": prep.sources,
        "final_columns": prep.final_columns,
        "final_rows": prep.final_rows,
        "medians": {"group": medians.group, "features": medians.grouped_features,
                    "overall": medians.overall, "has_groups": medians.grouped is not None},
        "target_encoded": list(encoding.lookups),
        "one_hot": asdict(prep.one_hot),
        "levels": {"features": list(prep.levels.slots), "null_as": prep.levels.null_as} if prep.wide else None,
    }, f"{path}/state")
    if prep.wide:
        prep.levels.state.write.mode("overwrite").parquet(f"{path}/levels")
    if medians.grouped is not None:
        medians.grouped.table.write.mode("overwrite").parquet(f"{path}/group_medians")
    encoding.state.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/target_means")
    return path


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    state = _read_json(spark, f"{path}/state")
    known = {field.name for field in fields(Settings)}
    settings = {k: tuple(v) if isinstance(v, list) else v for k, v in state["settings"].items() if k in known}
    prep = Preprocessor(Settings(**settings), state["final_rows"])
    m = state["medians"]
    groups = None
    if m["has_groups"]:
        groups = measured(spark.read.parquet(f"{path}/group_medians"))
    prep.medians = Medians(m["group"], groups, m["features"], m["overall"])
    means = spark.read.schema("level string, mean double, n bigint, feature string").parquet(
        f"{path}/target_means")
    prep.target_encoding = target_encoding(means, state["target_encoded"])
    prep.one_hot = OneHot(**state["one_hot"])
    if state.get("levels"):
        table = spark.read.schema(sparse.STATE).parquet(f"{path}/levels")
        prep.levels = sparse.level_index(table, state["levels"]["features"], state["levels"]["null_as"])
    prep.sources, prep.final_columns = state["sources"], state["final_columns"]
    prep.fitted = True
    return prep


def save_best(spark: SparkSession, run: TrainingRun, path: str, metric: str = MODEL_METRIC) -> str:
    """Save the winning model with its metadata."""
    best = run.best(metric)
    figures = run.results.where(F.col("model") == best.key).first().asDict()
    best.stages().write().overwrite().save(f"{path}/model")
    _write_json(spark, {
        "saved_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "model": {"key": best.key, "name": MODEL_NAMES.get(best.key, best.key), "rounds": best.best_iteration,
                  "features": best.features},
        "chosen_by": metric,
        "validation": {k: v for k, v in figures.items() if k not in ("model", "train_seconds")},
    }, f"{path}/metadata")
    return path


def load_best(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), _read_json(spark, f"{path}/metadata")


def save_params(trials_best: DataFrame, path: str) -> str:
    """Save the settings of the best trial as JSON."""
    trials_best.select("params").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
