import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelcast.operators import evaluate, train, tune
from gavelcast.params import BOOSTING_PARAMS


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 3)) * [1.0, 5.0, 0.2]
    y = 3 + x @ [0.5, -0.2, 2.0] + np.sin(3 * x[:, 0]) + rng.normal(0, 0.1, 600)
    return x, y


@pytest.fixture(scope="module")
def frames(spark, matrix):
    x, y = matrix
    rows = [(*map(float, r), float(v), float(np.expm1(v))) for r, v in zip(x, y)]
    schema = "a double, b double, c double, ly double, y double"
    names = ["a", "b", "c"]

    def frame(part):
        return train.assemble(spark.createDataFrame(part, schema), names, "ly", ["y"]).persist()

    return frame(rows[:400]), frame(rows[400:]), names


def test_ridge_equals_closed_form(frames, matrix):
    rows, _, names = frames
    x, y = matrix[0][:400], matrix[1][:400]
    for alpha in (1.0, 50.0):
        model = train.ridge(rows, names, alpha).model
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert model.coefficients.toArray().tolist() == pytest.approx(w.tolist(), abs=1e-6)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-6)


def test_boosting_arguments():
    got = train.boosting_arguments(train.BOOSTING_DEFAULTS)
    assert got["maxDepth"] == 7 and got["maxBins"] == 64 and got["maxIter"] == 20000 and got["stepSize"] == 0.0927 / 2
    assert got["minInstancesPerNode"] == 20 and got["subsamplingRate"] == 0.779
    assert got["featureSubsetStrategy"] == "0.943"
    with pytest.raises(ValueError, match="no counterpart"):
        train.boosting_arguments(BOOSTING_PARAMS)
    with pytest.raises(ValueError, match="num_leaves"):
        train.boosting_arguments({"num_leaves": 137})
    with pytest.raises(ValueError, match="max_depth"):
        train.boosting_arguments({"max_depth": 31})
    with pytest.raises(ValueError, match="unknown"):
        train.boosting_arguments({"typo": 1})


BOOST = {"n_estimators": 12, "learning_rate": 0.9, "max_depth": 4, "min_child_samples": 2, "subsample": 1.0, "colsample_bytree": 1.0}


def test_learning_rate_scales_the_residual(spark):
    """Two rounds of stumps by hand: mean per side, then a share of the mean residual."""
    ys = [1.0, 2.0, 10.0, 14.0]
    rows = spark.createDataFrame([(float(i), y) for i, y in enumerate(ys)], "x double, y double")
    data = train.assemble(rows, ["x"], "y")
    settings = {"n_estimators": 2, "learning_rate": 0.5, "max_depth": 1, "min_child_samples": 1, "subsample": 1.0, "colsample_bytree": 1.0}
    model = train.boosted_trees(data, data, ["x"], settings).model
    got = [r["prediction"] for r in model.transform(data).orderBy(train.LABEL).collect()]
    # First split after x=1: 1.5 and 12. Residuals -.5, .5, -2, 2 split best after x=2.
    assert got == pytest.approx([1.5 - 1 / 3, 1.5 - 1 / 3, 12 - 1 / 3, 12 + 1.0])


def test_early_stopping_keeps_the_best_round(frames):
    rows, validation, names = frames
    fitted = train.boosted_trees(rows, validation, names, BOOST, patience=3, block=4)
    curve = [r["rmse"] for r in fitted.curve.orderBy("iteration").collect()]
    assert fitted.best_iteration == int(np.argmin(curve)) + 1
    assert fitted.model.getNumTrees == fitted.best_iteration
    scored = fitted.predict(validation, "p")
    got = evaluate.rmse(scored, train.LABEL, "p").first()["rmse"]
    assert got == pytest.approx(min(curve), rel=1e-9)


def test_patience_ends_a_run_with_the_published_cap(spark, frames, tmp_path):
    """20,000 rounds allowed, sampled rows: the rule ends the run, and the winner is its first rounds."""
    rows, validation, names = frames
    settings = {"learning_rate": 0.6, "max_depth": 4, "subsample": 0.7, "colsample_bytree": 1.0}
    fitted = train.boosted_trees(rows, validation, names, settings, patience=4, block=6)
    rounds = fitted.curve.agg(F.max("iteration")).first()[0]
    assert fitted.stopped_early and rounds == fitted.best_iteration + 4 < 20000
    assert train.best_iteration(fitted.curve, 4).first()["stopped"] == 1
    scored = evaluate.rmse(fitted.predict(validation, "p"), train.LABEL, "p").first()["rmse"]
    assert scored == pytest.approx(fitted.curve.agg(F.min("rmse")).first()[0], rel=1e-9)
    fitted.model.write().save(str(tmp_path / "m"))
    again = type(fitted.model).load(str(tmp_path / "m"))
    assert again.getNumTrees == fitted.best_iteration


def test_train_all_and_importance(spark, frames):
    rows, validation, names = frames
    run = train.train_all(rows, validation, names, "y", {"ridge": {"alpha": 1.0}, "boosted_trees": {**BOOST, "patience": 5}})
    results = {r["model"]: r for r in run.results.collect()}
    assert set(results) == {"ridge", "boosted_trees"}
    assert all(r["train_seconds"] > 0 for r in results.values())
    assert run.best("MAE").key == min(results, key=lambda k: results[k]["MAE"])
    board = run.leaderboard("MAE").collect()
    assert board[0]["MAE"] <= board[1]["MAE"]
    assert {r["name"] for r in board} == {"Ridge Regression", "Boosted Trees"}
    assert run.importance(spark, "forest") is None
    linear = run.importance(spark, "ridge", 2).collect()
    assert linear[0]["feature"] == "c" and len(linear) == 2
    trees = evaluate.feature_importance(spark, run.models["boosted_trees"].model, names)
    assert trees.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    bars = [r["importance"] for r in evaluate.importance_bars(trees, 2).collect()]
    assert bars == sorted(bars) and len(bars) == 2
    assert evaluate.feature_importance(spark, object(), names) is None


def test_unknown_model_and_empty_run(frames):
    rows, validation, names = frames
    with pytest.raises(NotImplementedError):
        train.train_one("forest", rows, validation, names, {})
    with pytest.raises(RuntimeError):
        train.train_all(rows, validation, names, "y", {}).best()


def test_random_search_does_not_depend_on_parallelism(frames):
    rows, validation, names = frames
    space = {"learning_rate": (0.05, 0.5, "log"), "max_depth": (2, 4, "int"), "subsample": (0.6, 1.0, "float")}
    one, two = [
        tune.random_search(rows, validation, names, 2, space, trees=4, patience=2, parallel=p)
        for p in (1, 2)]
    assert sorted(one.collect()) == sorted(two.collect())
    best = tune.best_trial(one).first()
    assert best["rmse"] == one.agg(F.min("rmse")).first()[0]
