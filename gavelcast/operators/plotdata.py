"""Ready-to-plot tables: distributions, densities, trends and impact figures.

Ranges and spreads are one-row aggregates read into literals; the tables
themselves come from a single grouped pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quantiles import FINAL_ROWS, quantiles
from ..params import KDE_POINTS, PRICE_BINS, RESIDUAL_BINS, YEARLY_SALES
from . import evaluate

# exp(-z*z/2) is exactly 0 in double arithmetic beyond this many bandwidths.
KERNEL_REACH = 39.0
# Width of the cells of a density in bandwidths, and terms of the kernel's series in a cell.
KDE_CELL = 1 / 16
KDE_TERMS = 14
# Cells of the spline of a smooth trend.
SPLINE_CELLS = 20


def _present(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("x")).where(value.isNotNull() & ~F.isnan(value))


def bin_index(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin number; the last bin includes its upper end. Values outside count in the end bins."""
    if high <= low:
        # A constant column gets a unit-wide range around its value.
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.floor((value - F.lit(low)) / F.lit(width))
    return F.greatest(F.least(number, F.lit(bins - 1)), F.lit(0)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = PRICE_BINS) -> DataFrame:
    """``(bin, lower, upper, count, density)`` for every bin, empty ones included."""
    values = _present(df, column)
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                      F.count("x").alias("n")).first()
    low, high = span["lo"], span["hi"]
    grid = df.sparkSession.range(bins if span["n"] else 0).select(F.col("id").cast("int").alias("bin"))
    if not span["n"]:
        low, high = 0.0, 1.0
    counted = values.groupBy(bin_index(F.col("x"), low, high, bins).alias("bin")).agg(
        F.count("x").alias("count"))
    if high <= low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    count = F.coalesce(F.col("count"), F.lit(0))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        count.alias("count"),
        (count / F.lit(max(span["n"], 1) * width)).alias("density"),
    )


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients of the (probabilists') Hermite polynomials up to a degree, lowest power first."""
    out = [[1], [0, 1]]
    for k in range(1, terms):
        up, down = [0, *out[k]], [*out[k - 1], 0, 0]
        out.append([a - k * b for a, b in zip(up, down)])
    return out[:terms + 1]


def _polynomial(coefficients: Sequence[int], at: Column) -> Column:
    value = F.lit(float(coefficients[-1]))
    for coefficient in reversed(coefficients[:-1]):
        value = value * at + F.lit(float(coefficient))
    return value


def kde(df: DataFrame, column: str, points: int = KDE_POINTS) -> DataFrame:
    """Gaussian density on an even grid, Scott bandwidth: ``(point, x, density)`` for every point.

    Values are gathered in cells ``KDE_CELL`` bandwidths wide, each kept as its count and the sums of the powers of the
    distance from its centre: one partial aggregation of as many rows as there are cells, whatever the number of
    values. A cell then adds to the points its kernel reaches, by the Hermite series of the kernel about the centre.
    With ``t = KDE_CELL / 2`` the first term left out is below ``1.09 * t ** 15 / sqrt(15!)`` of the kernel's peak, that is
    3e-29, and at ``u`` bandwidths about ``(u * t) ** 15 / 15!`` of the kernel there, 2e-11 at the far end of its reach: the
    error is that of double arithmetic near the values and stays small beside the density far from them.
    """
    values = _present(df, column)
    s = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"),
                   F.stddev_samp("x").alias("sd")).first()
    if s["n"] < 2 or not s["sd"]:
        raise ValueError("a density needs at least two different values")
    low, n = s["lo"], s["n"]
    step = (s["hi"] - low) / (points - 1)
    width = s["sd"] * n ** (-1 / 5)
    reach = (KERNEL_REACH + KDE_CELL) * width
    side = KDE_CELL * width

    cell = F.floor((F.col("x") - F.lit(low)) / F.lit(side))
    placed = values.select("x", cell.alias("cell")).select(
        "cell", ((F.col("x") - F.lit(low) - (F.col("cell") + 0.5) * F.lit(side)) / F.lit(width)).alias("t"))
    powers = [F.lit(1.0)]
    for _ in range(KDE_TERMS):
        powers.append(powers[-1] * F.col("t"))
    moments = placed.groupBy("cell").agg(*[
        (F.sum(power) / math.factorial(k)).alias(f"m{k}") for k, power in enumerate(powers)])

    centre = (F.col("cell") + 0.5) * F.lit(side)
    first = F.greatest(F.lit(0), F.ceil((centre - F.lit(reach)) / F.lit(step)))
    last = F.least(F.lit(points - 1), F.floor((centre + F.lit(reach)) / F.lit(step)))
    # Between two points of a coarse grid a narrow kernel reaches none.
    reached = F.when(first <= last, F.sequence(first, last, F.lit(1).cast("long")))
    spread = moments.select("*", F.explode(reached).alias("point"))
    spread = spread.withColumn("u", (F.col("point") * F.lit(step) - centre) / F.lit(width))
    series = F.lit(0.0)
    for k, coefficients in enumerate(_hermite(KDE_TERMS)):
        series = series + F.col(f"m{k}") * _polynomial(coefficients, F.col("u"))
    scale = n * width * (2 * math.pi) ** 0.5
    density = spread.groupBy("point").agg(
        (F.sum(series * F.exp(F.col("u") * F.col("u") * F.lit(-0.5))) / F.lit(scale)).alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").alias("point"))
    return grid.join(density, "point", "left").select(
        F.col("point").cast("int").alias("point"), (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        F.greatest(F.coalesce("density", F.lit(0.0)), F.lit(0.0)).alias("density"))


def summary(df: DataFrame, column: str, final_rows: int = FINAL_ROWS) -> DataFrame:
    """``(n, mean, median, std)`` of the values present; std has ddof 1."""
    values = _present(df, column)
    middle = quantiles(values, ["x"], [0.5], final_rows=final_rows).first()
    return values.agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"),
        F.lit(middle["quantile"] if middle else None).cast("double").alias("median"),
        F.stddev_samp("x").alias("std"))


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; 0 for constant values, missing below three rows."""
    n = F.count(value).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    constant = F.min(value) == F.max(value)
    return F.when(n < 3, F.lit(None).cast("double")).when(constant, 0.0).otherwise(
        F.skewness(value) * factor)


def residual_summary(df: DataFrame, residual: str = "residual") -> DataFrame:
    """``(mean, std, skew)`` of residuals; std has ddof 0."""
    r = F.col(residual)
    return df.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"),
                  sample_skewness(r).alias("skew"))


def _span(df: DataFrame, *columns: str) -> dict[str, tuple[float, float]]:
    row = df.agg(*[agg(F.col(n).cast("double")).alias(f"{tag}{i}")
                   for i, n in enumerate(columns)
                   for tag, agg in (("lo", F.min), ("hi", F.max))]).first()
    return {n: (row[f"lo{i}"] or 0.0, row[f"hi{i}"] or 0.0) for i, n in enumerate(columns)}


def scatter(df: DataFrame, bins: int = 60, y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Actual against predicted as 2-D bin counts with the mean error of each bin.

    Both axes share one range, so the ideal line is the diagonal: from 0, or from 5 % below
    the smallest value if that is negative, to 5 % above the largest, or to 0. Every row is counted.
    """
    spans = _span(df, y, prediction).values()
    bottom = min(0.0, 1.05 * min(low for low, _ in spans))
    top = max(0.0, 1.05 * max(high for _, high in spans))
    actual, predicted = F.col(y).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(
        bin_index(actual, bottom, top, bins).alias("y_bin"),
        bin_index(predicted, bottom, top, bins).alias("prediction_bin"),
    ).agg(F.count(F.lit(1)).alias("count"), F.avg(F.abs(actual - predicted)).alias("mean_abs_error"))


def binned_trend(df: DataFrame, bins: int = 50, y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Mean and spread of residuals along the prediction axis."""
    low, high = _span(df, prediction)[prediction]
    p = F.col(prediction).cast("double")
    r = F.col(y).cast("double") - p
    return df.groupBy(bin_index(p, low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(p).alias("mean_prediction"),
        F.avg(r).alias("mean_residual"), F.stddev_pop(r).alias("std_residual"))


def _spline_pieces(t):
    """The four cubic B-splines over a unit cell, at the place ``t`` within it; for columns and arrays alike."""
    u = 1 - t
    return [u * u * u / 6, (3 * t * t * t - 6 * t * t + 4) / 6, (3 * u * u * u - 6 * u * u + 4) / 6, t * t * t / 6]


def smooth_trend(
    df: DataFrame, y: str = "y", prediction: str = "prediction", cells: int = SPLINE_CELLS, points: int = 100,
    penalty: float | None = None,
) -> DataFrame:
    """Smooth mean of residuals along the prediction axis: ``(point, prediction, residual)``.

    A cubic spline on equal cells, whose second differences are penalised. One aggregation sums, per cell, the products
    of its four basis functions with each other and with the residual; the normal equations of ``cells + 3`` unknowns
    are solved on the driver. Without a ``penalty`` the one of least generalised cross-validation is taken. Rows with a
    missing value are left out; without rows the result is empty, and with a constant prediction it is the mean.
    """
    spark = df.sparkSession
    rows = df.select(F.col(prediction).cast("double").alias("p"), (F.col(y) - F.col(prediction)).cast("double").alias("r")).where(
        F.col("p").isNotNull() & F.col("r").isNotNull() & ~F.isnan("p") & ~F.isnan("r"))
    low, high = _span(rows, "p")["p"]
    schema = "point int, prediction double, residual double"
    if high <= low:
        mean = rows.agg(F.avg("r")).first()[0]
        return spark.createDataFrame([] if mean is None else [(0, low, mean)], schema)
    width = (high - low) / cells
    placed = rows.select("r", bin_index(F.col("p"), low, high, cells).alias("cell"), "p")
    placed = placed.select("r", "cell", ((F.col("p") - F.lit(low)) / F.lit(width) - F.col("cell")).alias("t"))
    basis = _spline_pieces(F.col("t"))
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    sums = placed.groupBy("cell").agg(
        F.count("r").alias("n"), F.sum(F.col("r") * F.col("r")).alias("rr"),
        *[F.sum(basis[i] * basis[j]).alias(f"b{i}{j}") for i, j in pairs], *[F.sum(b * F.col("r")).alias(f"r{i}") for i, b in enumerate(basis)])

    size = cells + 3
    gram, right, n, squares = np.zeros((size, size)), np.zeros(size), 0, 0.0
    for row in sums.orderBy("cell").collect():
        k = row["cell"]
        for i, j in pairs:
            gram[k + i, k + j] += row[f"b{i}{j}"]
            if i != j:
                gram[k + j, k + i] += row[f"b{i}{j}"]
        right[k:k + 4] += [row[f"r{i}"] for i in range(4)]
        n, squares = n + row["n"], squares + row["rr"]
    bend = np.diff(np.eye(size), 2, axis=0)
    rough = bend.T @ bend

    def solved(weight):
        return np.linalg.solve(gram + weight * rough + 1e-12 * n * np.eye(size), np.column_stack([right, gram]))

    def crossed(weight):
        found = solved(weight)
        left = squares - 2 * found[:, 0] @ right + found[:, 0] @ gram @ found[:, 0]
        return n * max(left, 0.0) / max(n - np.trace(found[:, 1:]), 1e-9) ** 2

    weight = penalty if penalty is not None else min((n * 10.0 ** e for e in range(-8, 4)), key=crossed)
    weights = solved(weight)[:, 0]
    at = np.linspace(low, high, points)
    cell = np.clip(((at - low) / width).astype(int), 0, cells - 1)
    values = sum(piece * weights[cell + i] for i, piece in enumerate(_spline_pieces((at - low) / width - cell)))
    return spark.createDataFrame([(i, float(a), float(v)) for i, (a, v) in enumerate(zip(at, values))], schema)


def business_impact(
    df: DataFrame, baseline: str = "median_predictor", y: str = "y",
    prediction: str = "prediction", yearly_sales: int = YEARLY_SALES,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """What the model saves over a baseline.

    ``median_predictor`` is the error of always quoting the median price;
    ``median_price`` takes the median price itself as the baseline error.
    """
    if baseline not in ("median_predictor", "median_price"):
        raise ValueError("baseline must be 'median_predictor' or 'median_price'")
    median = evaluate.quantile_edges(df, y, 2, final_rows)
    middle = F.lit(median[0] if median else None).cast("double")
    actual, predicted = F.col(y).cast("double"), F.col(prediction).cast("double")
    errors = df.agg(
        F.avg(F.abs(actual - predicted)).alias("model_mae"),
        F.avg(F.abs(actual - middle)).alias("median_mae"),
    )
    base = F.col("median_mae") if baseline == "median_predictor" else middle
    gain = F.col("baseline_mae") - F.col("model_mae")
    return errors.select("model_mae", base.alias("baseline_mae")).select(
        "baseline_mae", "model_mae", gain.alias("improvement"),
        (F.try_divide(gain, F.col("baseline_mae")) * 100).alias("improvement_percent"),
        (gain * yearly_sales).alias("annual_savings"),
    )


def all_tables(
    raw: DataFrame, target: str, predictions: DataFrame, model: str,
    importance: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every table of a report. ``predictions`` should be stored or persisted."""
    chosen = evaluate.residuals(predictions.where(F.col("model") == model))
    tables = {
        "target_histogram": histogram(raw, target, PRICE_BINS),
        "target_kde": kde(raw, target),
        "target_summary": summary(raw, target),
        "actual_vs_predicted": scatter(chosen),
        "model_metrics": evaluate.metrics(chosen),
        "residual_histogram": histogram(chosen, "residual", RESIDUAL_BINS),
        "residual_kde": kde(chosen, "residual"),
        "residual_summary": residual_summary(chosen),
        "residual_trend": binned_trend(chosen),
        "residual_smooth": smooth_trend(chosen),
        "model_comparison": evaluate.compare(predictions),
        "business_impact": business_impact(chosen),
    }
    if importance is not None:
        tables["feature_importance"] = evaluate.importance_bars(importance)
    return tables
