"""Error tables over predictions.

Predictions come as ``(model, y, prediction)`` rows on the original scale, all
models in one frame, so each table is one aggregation with map-side partials.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import absolute_error, percent_error, residual, to_original_scale
from ..functions.quantiles import FINAL_ROWS, quantiles
from ..params import MODEL_METRIC, PRICE_SEGMENTS

HIGHER_IS_BETTER = ("R2",)
ERROR_COLUMNS = ("MAE", "RMSE", "R2", "MAPE")


def error_aggregates(y: Column, p: Column) -> list[Column]:
    """MAE, RMSE, R2 and MAPE in one pass.

    R2 is 1 - SSE/SST, not a squared correlation. A constant target scores 1 when
    hit exactly, else 0; fewer than two rows score nothing.
    """
    error = y - p
    sse, n = F.sum(error * error), F.count(error)
    sst = F.var_pop(F.when(p.isNotNull(), y)) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst > 0, 1 - F.try_divide(sse, sst))
        .otherwise(F.when(sse == 0, 1.0).otherwise(0.0))
    )
    share = F.when(y != 0, F.abs(F.try_divide(error, y)))
    return [
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        r2.alias("R2"),
        (F.avg(share) * 100).alias("MAPE"),
    ]


def metrics(df: DataFrame, by: Sequence[str] = (), y="y", prediction="prediction") -> DataFrame:
    y, p = F.col(y).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(*by).agg(*error_aggregates(y, p))


def evaluate(df: DataFrame, log_prediction: str, y: str = "y") -> DataFrame:
    """Metrics of one model whose predictions are on the log scale."""
    scaled = df.select(F.col(y).alias("y"),
                       to_original_scale(F.col(log_prediction)).alias("prediction"))
    return metrics(scaled)


def rmse(df: DataFrame, y: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(y) - F.col(prediction)
    return df.groupBy(*by).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def long_predictions(df: DataFrame, log_columns: dict[str, str], y: str,
                     carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row and model from side-by-side log predictions: no second scan."""
    cells = [
        F.struct(F.lit(model).alias("model"), F.col(y).cast("double").alias("y"),
                 to_original_scale(F.col(column)).alias("prediction"))
        for model, column in log_columns.items()
    ]
    return df.select(*carry, F.inline(F.array(*cells)))


def compare(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per model, best R2 first."""
    return metrics(predictions, [*by, "model"]).orderBy(*by, F.desc("R2"), "model")


def _better_first(metric: str) -> Column:
    return F.desc(metric) if metric in HIGHER_IS_BETTER else F.asc_nulls_last(metric)


def leaderboard(results: DataFrame, metric: str = MODEL_METRIC) -> DataFrame:
    """Results sorted so that the best model by ``metric`` is on top."""
    return results.orderBy(_better_first(metric), "model")


def best_model(results: DataFrame, metric: str = MODEL_METRIC) -> DataFrame:
    """The winning row."""
    ranked = results.where(F.col(metric).isNotNull())
    return ranked.orderBy(_better_first(metric), "model").limit(1)


def best_model_key(results: DataFrame, metric: str = MODEL_METRIC) -> str:
    winner = best_model(results, metric).select("model").first()
    if winner is None:
        raise RuntimeError("no model has been trained")
    return winner["model"]


def summary(by_split: DataFrame, metric: str = MODEL_METRIC, judged_on: str = "val") -> DataFrame:
    """Validation and test figures of the model that wins on ``judged_on``.

    Reads ``(split, model, MAE, RMSE, R2, MAPE)``; returns one row per metric.
    """
    winner = best_model(by_split.where(F.col("split") == judged_on), metric).select("model")
    rows = by_split.join(F.broadcast(winner), "model", "left_semi")  # one row by construction
    long = rows.unpivot(["model", "split"], list(ERROR_COLUMNS), "metric", "value")
    return long.groupBy("model", "metric").agg(
        F.max(F.when(F.col("split") == "val", F.col("value"))).alias("validation"),
        F.max(F.when(F.col("split") == "test", F.col("value"))).alias("test"),
    )


def quantile_edges(
    df: DataFrame, column: str, buckets: int, final_rows: int = FINAL_ROWS
) -> list[float]:
    """Inner edges between ``buckets`` equally filled ranges; a handful of scalars."""
    probs = [i / buckets for i in range(1, buckets)]
    found = quantiles(df, [column], probs, final_rows=final_rows)
    return [r["quantile"] for r in found.orderBy("prob").collect()]


def bucket_of(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed ranges between the edges; tied edges leave a range empty."""
    chosen = F.lit(labels[len(edges)])
    for edge, label in reversed(list(zip(edges, labels))):
        chosen = F.when(column <= F.lit(edge), label).otherwise(chosen)
    return F.when(column.isNotNull(), chosen)


def by_quantile(
    df: DataFrame, y: str = "y", prediction: str = "prediction",
    labels: Sequence[str] = PRICE_SEGMENTS, final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """Errors per price segment: ``(segment, count, MAE, RMSE, R2, MAPE)``."""
    actual, predicted = F.col(y).cast("double"), F.col(prediction).cast("double")
    edges = quantile_edges(df, y, len(labels), final_rows)
    order = F.array_position(F.array(*[F.lit(label) for label in labels]), F.col("segment"))
    return (
        df.withColumn("segment", bucket_of(actual, edges, labels))
        .where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("count"), *error_aggregates(actual, predicted))
        .orderBy(order)
    )


def residuals(df: DataFrame, y: str = "y", prediction: str = "prediction") -> DataFrame:
    actual, predicted = F.col(y), F.col(prediction)
    return df.select("*", residual(actual, predicted).alias("residual"),
                     absolute_error(actual, predicted).alias("abs_error"))


def worst(
    df: DataFrame, n: int = 10, y: str = "y", prediction: str = "prediction",
    tie_break: Sequence[str] = (), digits: int = 2,
) -> DataFrame:
    """The ``n`` largest absolute errors: a per-task top list, merged at the end."""
    actual, predicted = F.col(y).cast("double"), F.col(prediction).cast("double")
    table = df.select(
        actual.alias("true_price"), predicted.alias("predicted_price"),
        absolute_error(actual, predicted).alias("error"),
        percent_error(actual, predicted).alias("error_percent"), *tie_break,
    )
    top = table.orderBy(F.desc("error"), *tie_break).limit(n)
    figures = ("true_price", "predicted_price", "error", "error_percent")
    return top.select(*tie_break, *[F.round(name, digits).alias(name) for name in figures])


def feature_importance(
    spark, model, features: Sequence[str] | DataFrame, top_n: int = 20
) -> DataFrame | None:
    """Top features by normalised impurity gain (trees) or absolute coefficient (linear).

    ``features`` are names in order, or a table ``(position, feature)`` where there are too many for a list.
    """
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        weights = abs(model.coefficients.toArray())
    else:
        return None
    # Only positions that can be among the first: the least of them may be shared by many.
    least = sorted(weights, reverse=True)[:top_n][-1] if len(weights) else 0.0
    found = [(i, float(w)) for i, w in enumerate(weights) if w >= least]
    if not isinstance(features, DataFrame):
        names = list(features)
        # A model of trees knows no feature behind the last it uses.
        found += [(i, 0.0) for i in range(len(weights), len(names))]
        table = spark.createDataFrame([(names[i], w) for i, w in found], "feature string, importance double")
    else:
        table = spark.createDataFrame(found, "position long, importance double")
        table = features.join(table, "position", "left" if not least else "inner").select(
            "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
    return table.orderBy(F.desc("importance"), "feature").limit(top_n)


def importance_bars(importance: DataFrame, top_n: int = 15) -> DataFrame:
    """The first ``top_n`` of an importance table, smallest first, as a bar chart wants them."""
    top = importance.orderBy(F.desc("importance"), "feature").limit(top_n)
    return top.orderBy(F.asc("importance"), F.desc("feature"))
