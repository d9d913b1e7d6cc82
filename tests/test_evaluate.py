import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gavelcast.operators import evaluate, plotdata
from gavelcast.operators.train import best_iteration


def pairs(spark, ys, ps):
    return spark.createDataFrame(
        [(i, float(y), float(p)) for i, (y, p) in enumerate(zip(ys, ps))],
        "id int, y double, prediction double")


def test_metrics(spark):
    got = evaluate.metrics(pairs(spark, [0, 100, 200, 400], [10, 90, 200, 500])).first()
    assert got["MAE"] == 30.0
    assert got["RMSE"] == pytest.approx(50.497525, abs=1e-6)
    assert got["R2"] == pytest.approx(0.883429, abs=1e-6)
    assert got["MAPE"] == pytest.approx(11.666667, abs=1e-6)


def test_mape_of_zeros_is_missing(spark):
    assert evaluate.metrics(pairs(spark, [0, 0], [1, 2])).first()["MAPE"] is None


@pytest.mark.parametrize("ys, ps, r2", [
    ([5, 5], [5, 5], 1.0), ([5, 5], [5, 6], 0.0), ([5], [5], None)])
def test_r2_of_constant_target(spark, ys, ps, r2):
    assert evaluate.metrics(pairs(spark, ys, ps)).first()["R2"] == r2


def test_evaluate_undoes_the_logarithm(spark):
    df = spark.createDataFrame([(100.0, math.log1p(90.0)), (50.0, math.log1p(50.0))], "y double, lp double")
    assert evaluate.evaluate(df, "lp").first()["MAE"] == pytest.approx(5.0)


def test_by_quantile_even_and_tied(spark):
    got = evaluate.by_quantile(pairs(spark, range(1, 11), range(1, 11))).collect()
    assert [(r["segment"], r["count"]) for r in got] == [
        ("Very Low", 2), ("Low", 2), ("Medium", 2), ("High", 2), ("Very High", 2)]
    tied = evaluate.by_quantile(pairs(spark, [1, 1, 1, 1, 2, 3], [1] * 6)).collect()
    assert [(r["segment"], r["count"]) for r in tied] == [("Very Low", 4), ("High", 1), ("Very High", 1)]


def test_by_quantile_equals_pandas(spark):
    rng = np.random.default_rng(0)
    y = rng.lognormal(9, 1, 503)
    codes = pd.qcut(y, 5, labels=False)
    got = evaluate.by_quantile(pairs(spark, y, y * 1.1), final_rows=60).collect()
    assert [r["count"] for r in got] == np.bincount(codes).tolist()
    assert [r["MAE"] for r in got] == pytest.approx([np.mean(y[codes == k] * 0.1) for k in range(5)])


def test_worst(spark):
    df = pairs(spark, [10, 0, 30], [11, 5, 10])
    got = evaluate.worst(df, 2, tie_break=["id"]).collect()
    assert [tuple(r) for r in got] == [(2, 30.0, 10.0, 20.0, 66.67), (1, 0.0, 5.0, 5.0, None)]
    assert evaluate.worst(df, 50).count() == 3


@pytest.fixture
def results(spark):
    return spark.createDataFrame(
        [("val", "a", 5.0, 9.0, 0.7, 1.0), ("val", "b", 4.0, 9.5, 0.6, 2.0),
         ("test", "a", 6.0, 9.1, 0.65, 3.0), ("test", "b", 3.0, 9.2, 0.8, 4.0)],
        "split string, model string, MAE double, RMSE double, R2 double, MAPE double")


def test_best_model_and_leaderboard(results):
    val = results.where("split = 'val'")
    assert evaluate.best_model_key(val) == "a"
    assert evaluate.best_model_key(val, "MAE") == "b"
    assert [r["model"] for r in evaluate.leaderboard(val, "MAE").collect()] == ["b", "a"]
    with pytest.raises(RuntimeError):
        evaluate.best_model_key(val.where("false"))


def test_summary_follows_the_validation_winner(results):
    got = {r["metric"]: (r["model"], r["validation"], r["test"]) for r in evaluate.summary(results).collect()}
    assert got["R2"] == ("a", 0.7, 0.65) and got["MAPE"] == ("a", 1.0, 3.0)


@pytest.mark.parametrize("patience, best, last, stopped", [(3, 3, 6, 1), (4, 7, 7, 0)])
def test_patience(spark, patience, best, last, stopped):
    curve = [5, 4, 3, 3.5, 3.2, 3.1, 2.9]
    df = spark.createDataFrame(
        [("m", i + 1, float(v)) for i, v in enumerate(curve)], "model string, iteration int, rmse double")
    got = best_iteration(df, patience).first()
    assert (got["best_iteration"], got["last"], got["stopped"]) == (best, last, stopped)
    assert got["best_rmse"] == curve[best - 1]


def test_equal_error_is_no_improvement(spark):
    df = spark.createDataFrame([("m", i, 1.0) for i in range(1, 5)], "model string, iteration int, rmse double")
    assert best_iteration(df, 2).first()["best_iteration"] == 1


def test_summary_and_residual_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    s = plotdata.summary(df, "v").first()
    assert (s["n"], s["mean"], s["median"]) == (4, 4.0, 2.5)
    assert s["std"] == pytest.approx(4.082483, abs=1e-6)
    r = plotdata.residual_summary(df, "v").first()
    assert r["std"] == pytest.approx(3.535534, abs=1e-6)
    assert r["skew"] == pytest.approx(1.763633, abs=1e-6)
    flat = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert plotdata.residual_summary(flat, "v").first()["skew"] == 0.0
    assert plotdata.residual_summary(flat.limit(2), "v").first()["skew"] is None


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(1).normal(50, 20, 700).round(1)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = plotdata.histogram(df, "v", 12).orderBy("bin").collect()
    counts, edges = np.histogram(values, 12)
    density, _ = np.histogram(values, 12, density=True)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["lower"] for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r["density"] for r in got] == pytest.approx(density.tolist())


def test_histogram_keeps_empty_bins_and_constant_columns(spark):
    gap = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    assert [r["count"] for r in plotdata.histogram(gap, "v", 4).orderBy("bin").collect()] == [1, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,)] * 5, "v double")
    counts, _ = np.histogram([3.0] * 5, 4)
    assert [r["count"] for r in plotdata.histogram(flat, "v", 4).orderBy("bin").collect()] == counts.tolist()


@pytest.mark.parametrize("values", [
    np.random.default_rng(2).normal(0, 1, 300),
    np.concatenate([np.repeat([1.0, 2.0, 2.5], 100), [40.0]]),
])
def test_kde_equals_closed_form(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = plotdata.kde(df, "v", 60).orderBy("point").collect()
    n, width = len(values), values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 60)
    z = (grid[:, None] - values[None, :]) / width
    want = np.exp(-0.5 * z * z).sum(axis=1) / (n * width * np.sqrt(2 * np.pi))
    assert [r["point"] for r in got] == list(range(60))
    assert [r["x"] for r in got] == pytest.approx(grid.tolist())
    assert [r["density"] for r in got] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-300)


def test_scatter_and_trend_count_every_row(spark):
    rng = np.random.default_rng(4)
    y = rng.uniform(10, 100, 400)
    df = pairs(spark, y, y + rng.normal(0, 5, 400))
    cells = plotdata.scatter(df, 10)
    assert cells.agg(F.sum("count")).first()[0] == 400
    trend = plotdata.binned_trend(df, 8).collect()
    assert sum(r["count"] for r in trend) == 400 and {r["bin"] for r in trend} <= set(range(8))


def test_business_impact(spark):
    df = pairs(spark, [10, 20, 60], [12, 20, 50])
    got = plotdata.business_impact(df).first()
    assert got["baseline_mae"] == pytest.approx(50 / 3) and got["model_mae"] == 4.0
    assert got["annual_savings"] == pytest.approx((50 / 3 - 4) * 10_000)
    parity = plotdata.business_impact(df, "median_price").first()
    assert parity["improvement"] == 16.0 and parity["improvement_percent"] == 80.0


def test_smooth_trend_equals_a_direct_solve(spark):
    """The whole design matrix, built by recursion on knots, against sums per cell."""
    rows = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_totalprice").alias("prediction"), (F.col("o_totalprice") + F.sin(F.col("o_totalprice") / 40000) * 500 + F.col("o_orderkey") % 97).alias("y"))
    cells, weight = 12, 50.0
    got = plotdata.smooth_trend(rows, cells=cells, points=40, penalty=weight).orderBy("point").collect()
    pairs = np.array(rows.collect(), dtype=float)
    p, r = pairs[:, 0], pairs[:, 1] - pairs[:, 0]
    low, high = p.min(), p.max()
    knots = low + (high - low) / cells * np.arange(-3, cells + 4)

    def design(x):
        out = ((x[:, None] >= knots[:-1]) & (x[:, None] < knots[1:])).astype(float)
        for k in range(1, 4):
            out = ((x[:, None] - knots[:-k - 1]) / (knots[k:-1] - knots[:-k - 1]) * out[:, :-1]
                   + (knots[k + 1:] - x[:, None]) / (knots[k + 1:] - knots[1:-k]) * out[:, 1:])
        return out

    b = design(p)
    bend = np.diff(np.eye(cells + 3), 2, axis=0)
    w = np.linalg.solve(b.T @ b + weight * bend.T @ bend + 1e-12 * len(p) * np.eye(cells + 3), b.T @ r)
    at = np.array([g["prediction"] for g in got])
    assert at[0] == low and at[-1] == high
    assert [g["residual"] for g in got] == pytest.approx((design(at) @ w).tolist(), rel=1e-6, abs=1e-6)
    chosen = plotdata.smooth_trend(rows, cells=cells, points=40).collect()
    truth = [np.sin(g["prediction"] / 40000) * 500 + 48 for g in chosen]
    assert np.sqrt(np.mean([(g["residual"] - t) ** 2 for g, t in zip(chosen[2:-2], truth[2:-2])])) < 25


def test_smooth_trend_edges(spark):
    schema = "y double, prediction double"
    assert plotdata.smooth_trend(spark.createDataFrame([], schema)).collect() == []
    flat = plotdata.smooth_trend(spark.createDataFrame([(3.0, 1.0), (5.0, 1.0), (None, 1.0)], schema)).collect()
    assert [tuple(r) for r in flat] == [(0, 1.0, 3.0)]
    two = plotdata.smooth_trend(spark.createDataFrame([(1.0, 0.0), (12.0, 10.0)], schema), points=3).collect()
    assert [r["residual"] for r in two] == pytest.approx([1.0, 1.5, 2.0], abs=0.2)
