import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelcast.operators import boosting, train, tune
from gavelcast.runtime import discard, scratch_path, scratch_root

NAMES = ["a", "b", "c"]
PLAIN = {"n_estimators": 12, "learning_rate": 0.4, "max_depth": 3, "min_child_samples": 2, "subsample": 1.0, "colsample_bytree": 1.0}


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 3))
    y = 2 * x[:, 0] + np.sin(4 * x[:, 1]) + rng.normal(0, 0.3, 700)
    rows = spark.createDataFrame([(*map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, y))], "a double, b double, c double, y double, i int")
    data = train.assemble(rows, NAMES, "y", ["i"]).persist()
    yield data.where("i < 500").drop("i"), data.where("i >= 500").drop("i")
    data.unpersist()


def predictions(model, rows):
    return [r["prediction"] for r in model.transform(rows).orderBy(train.LABEL).collect()]


def test_blocks_do_not_change_a_run(frames, monkeypatch):
    rows, validation = frames
    whole = train.boosted_trees(rows, validation, NAMES, PLAIN, patience=50, block=12)
    monkeypatch.setattr(boosting, "BLOCK", 4)
    parts = train.boosted_trees(rows, validation, NAMES, PLAIN, patience=50, block=5)
    assert whole.best_iteration == parts.best_iteration
    assert predictions(parts.model, validation) == pytest.approx(predictions(whole.model, validation), rel=1e-9)
    a, b = [[r["rmse"] for r in f.curve.orderBy("iteration").collect()] for f in (whole, parts)]
    assert a == pytest.approx(b, rel=1e-9) and len(a) == 12


def test_no_round_is_fitted_twice(frames, monkeypatch):
    fitted = []
    learner = boosting.Boosting._learner
    monkeypatch.setattr(boosting.Boosting, "_learner", lambda self, arguments, number: fitted.append(number) or learner(self, arguments, number))
    led = []
    lead = boosting.Boosting._lead
    monkeypatch.setattr(boosting.Boosting, "_lead", staticmethod(lambda arguments, rounds: led.append(rounds) or lead(arguments, rounds)))
    got = train.boosted_trees(*frames, NAMES, {**PLAIN, "n_estimators": 500, "learning_rate": 0.9}, patience=3, block=4)
    assert got.stopped_early and led == [4] and fitted == list(range(4, 4 + len(fitted)))
    assert got.best_iteration + 3 <= 4 + len(fitted) < got.best_iteration + 3 + 4


def test_a_warm_start_goes_on_where_a_run_stood(frames):
    rows, validation = frames
    whole = train.boosted_trees(rows, validation, NAMES, {**PLAIN, "subsample": 0.7, "n_estimators": 9}, patience=50)
    first = boosting.Boosting(rows, validation, [train.boosting_arguments({**PLAIN, "subsample": 0.7})])
    first.advance([0], 4)
    more = boosting.Boosting(rows, validation, [train.boosting_arguments({**PLAIN, "subsample": 0.7})], warm=first.model(0, 4))
    more.advance([0], 5)
    errors = [r["rmse"] for r in whole.curve.orderBy("iteration").collect()]
    assert [*first.errors[0], *more.errors[0]] == pytest.approx(errors, rel=1e-9)
    assert more.model(0, 5).getNumTrees == 9
    again = train.boosted_trees(rows, validation, NAMES, {**PLAIN, "n_estimators": 3}, patience=50, warm=first.model(0, 4))
    assert again.model.getNumTrees == 4 + again.best_iteration


def test_samples_do_not_depend_on_partitions(frames):
    rows, validation = frames
    settings = {**PLAIN, "subsample": 0.5, "n_estimators": 4}
    one, two = [train.boosted_trees(rows.repartition(n), validation, NAMES, settings, patience=50) for n in (1, 7)]
    assert predictions(one.model, validation) == pytest.approx(predictions(two.model, validation), rel=1e-6)
    full = train.boosted_trees(rows, validation, NAMES, {**settings, "subsample": 1.0}, patience=50)
    assert predictions(full.model, validation) != pytest.approx(predictions(one.model, validation), rel=1e-3)


def test_patience_rule_equals_the_query(spark):
    rng = random.Random(4)
    curves = {f"c{k}": [round(rng.uniform(0.5, 1.0) / (1 + i / 9), 3) for i in range(30)] for k in range(6)}
    rows = spark.createDataFrame([(k, i, e) for k, es in curves.items() for i, e in enumerate(es, 1)], "model string, iteration int, rmse double")
    found = {r["model"]: (r["best_iteration"], r["best_rmse"], r["last"], bool(r["stopped"])) for r in train.best_iteration(rows, 4).collect()}
    assert found == {k: boosting.patience_rule(es, 4) for k, es in curves.items()}
    assert boosting.patience_rule([], 3) == (0, math.inf, 0, False)


def test_rows_are_needed(frames):
    rows, validation = frames
    for a, b in ((rows.where("false"), validation), (rows, validation.where("false"))):
        with pytest.raises(ValueError, match="rows"):
            train.boosted_trees(a, b, NAMES, PLAIN)


def test_stored_tables_go(spark, frames, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 2)
    before = set(_tables(spark))
    train.boosted_trees(*frames, NAMES, {**PLAIN, "n_estimators": 6}, patience=50, block=2)
    assert set(_tables(spark)) == before
    with pytest.raises(ValueError, match="not below"):
        discard(spark, "/somewhere/else")


def _tables(spark):
    import pathlib

    return [p.name for p in pathlib.Path(scratch_root(spark).removeprefix("file:")).glob("boosting*")]


SPACE = {"learning_rate": (0.02, 0.8, "log"), "max_depth": (1, 4, "int"), "subsample": (0.6, 1.0, "float")}


def test_halving_finds_the_winner_of_the_full_search_with_fewer_rounds(spark, frames):
    points = tune._points(SPACE, 5, 4)
    full = tune.race(*frames, points, trees=12, patience=6, block=4)
    halved = tune.race(*frames, points, trees=12, patience=6, block=4, halve=2, first=4)
    best = min(full, key=lambda r: (r[1], r[0]))
    assert min(halved, key=lambda r: (r[1], r[0]))[:4] == best[:4]
    assert sum(r[4] for r in halved) < sum(r[4] for r in full)
    assert {r[5] for r in halved} >= {"halved"} and all(r[4] <= 12 for r in full)
    table = tune.halving_search(*frames, NAMES, 4, SPACE, trees=12, patience=6, seed=5, halve=2, first=4)
    assert tune.best_trial(table).first()["params"] == json.dumps(points[best[0]], sort_keys=True)


def test_a_race_equals_runs_alone(frames, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 3)
    points = tune._points(SPACE, 9, 2)
    rows = tune.race(*frames, points, trees=8, patience=50, block=3)
    for row, point in zip(rows, points):
        alone = train.boosted_trees(*frames, NAMES, {**point, "n_estimators": 8, "seed": 42}, patience=50)
        assert row[2] == alone.best_iteration
        assert row[1] == pytest.approx(alone.curve.agg(F.min("rmse")).first()[0], rel=1e-9)


def test_files_are_read_in_the_order_of_their_tasks(spark, frames):
    rows, validation = frames
    run = boosting.Boosting(rows.repartition(9), validation, [train.boosting_arguments(PLAIN)])
    read = run.records[0]._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location().rootPaths()
    names = [str(read.apply(i)).rsplit("/", 1)[1] for i in range(read.size())]
    assert len(names) >= 9 and names == sorted(names)
    run.close()


def test_parzen_beats_random_draws():
    """A fixed function of a log-scaled, a whole and a plain setting, 20 seeds, the same number of trials."""
    space = {"rate": (1e-4, 1.0, "log"), "depth": (1, 15, "int"), "share": (0.0, 1.0, "float")}

    def error(p):
        return (math.log10(p["rate"]) + 1.5) ** 2 + (p["depth"] - 9) ** 2 / 20 + 4 * (p["share"] - 0.7) ** 2

    wins, gains = 0, []
    for seed in range(20):
        rng = random.Random(1000 + seed)
        by_chance = min(error(tune.draw(space, rng)) for _ in range(50))
        history = tune.parzen(lambda points: [error(p) for p in points], space, 50, seed)
        assert len(history) == 50 and all(space[n][0] <= p[n] <= space[n][1] for p, _ in history for n in space)
        assert all(isinstance(p["depth"], int) for p, _ in history)
        found = min(e for _, e in history)
        wins += found < by_chance
        gains.append(by_chance / found)
    assert wins >= 16 and sorted(gains)[10] > 2


def test_parzen_search_over_trees(spark, frames):
    got = tune.parzen_search(*frames, NAMES, 5, SPACE, trees=4, patience=3, at_once=2, startup=3)
    assert [r["trial"] for r in got.orderBy("trial").collect()] == list(range(5))
    assert got.schema.names == [c.split(" ")[0] for c in tune.RACE_SCHEMA.split(", ")]


def test_scratch_paths_lie_below_one_folder(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark) + "/x-")
