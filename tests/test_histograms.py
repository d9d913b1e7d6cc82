"""Trees from binned rows: exact cuts, compact tables, no rounds beyond what patience asks for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelcast.operators import boosting, histograms, train

STUMP = {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1, "min_child_samples": 1, "subsample": 1.0, "colsample_bytree": 1.0}


def test_a_rare_value_gets_its_cut(spark):
    """Two rows of 40,000 have the value that matters; a sample of 10,000 rows can miss them."""
    rows = spark.range(40_000, numPartitions=3).select(
        F.when(F.col("id").isin(17, 30_001), 5.0).otherwise(F.col("id") % 2).alias("x"),
        F.when(F.col("id").isin(17, 30_001), 1000.0).otherwise(1.0).alias("y"))
    data = train.assemble(rows, ["x"], "y")
    model = train.boosted_trees(data, data, ["x"], STUMP).model
    found = {r["p"] for r in model.setPredictionCol("p").transform(data).select("p").distinct().collect()}
    assert found == {1.0, 1000.0}


def test_few_rounds_past_the_best(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(float(v), float(v > 0)) for v in rng.normal(size=300)], "x double, y double")
    data = train.assemble(rows, ["x"], "y")
    fitted = []
    advance = boosting.Boosting.advance
    monkeypatch.setattr(boosting.Boosting, "advance", lambda self, runs, rounds, **more: fitted.append(rounds) or advance(self, runs, rounds, **more))
    got = train.boosted_trees(data, data, ["x"], {**STUMP, "n_estimators": 200, "learning_rate": 0.5}, patience=2)
    assert got.stopped_early and sum(fitted) <= got.best_iteration + 2


def test_the_stored_table_has_cells_instead_of_vectors(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(*map(float, r), float(r.sum())) for r in rng.integers(0, 4, (200, 3))], "a double, b double, c double, y double")
    data = train.assemble(rows, ["a", "b", "c"], "y")
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    run = boosting.Boosting(data, data, [train.boosting_arguments({**STUMP, "max_bins": 32})])
    run.advance([0], 2)
    assert set(run.train[0].columns) == {"__cells_32", "label", "__mark", "__sum_0"}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert run.train[0].agg(F.max(F.octet_length("__cells_32"))).first()[0] <= 3 * 2
    run.close()


@pytest.mark.parametrize("limits", [{}, {"HELD": 1, "TO_DRIVER": 0, "BLOCK_CELLS": 8}])
def test_trees_equal_mllibs(spark, monkeypatch, limits):
    """All rows are MLlib's sample here; the other limits take the paths of wide tables."""
    from pyspark.ml.regression import DecisionTreeRegressor

    for name, value in limits.items():
        monkeypatch.setattr(histograms, name, value)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(500, 4)), 2) * (rng.random((500, 4)) < 0.6)
    y = x[:, 0] * x[:, 1] + np.abs(x[:, 2]) + rng.normal(0, 0.1, 500)
    rows = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")
    data = train.assemble(rows, ["a", "b", "c", "d"], "y").repartition(3).persist()
    ours = train.boosted_trees(data, data, list("abcd"), {**STUMP, "max_depth": 4, "min_child_samples": 7, "max_bins": 16}).model
    theirs = DecisionTreeRegressor(featuresCol=train.FEATURES, labelCol=train.LABEL, maxDepth=4, maxBins=16, minInstancesPerNode=7).fit(data)
    one, two = [[r["prediction"] for r in m.transform(data).orderBy(train.LABEL).collect()] for m in (ours, theirs)]
    assert one == pytest.approx(two, rel=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-6)
    data.unpersist()


def test_passes_read_records_of_many_rows(spark):
    """Handing rows to Python one by one cost more than the trees."""
    rows = spark.range(20_000, numPartitions=2).select((F.col("id") % 977).cast("double").alias("x"), F.sqrt("id").alias("y"))
    data = train.assemble(rows, ["x"], "y")
    run = boosting.Boosting(data, data, [train.boosting_arguments({**STUMP, "subsample": 0.5})])
    assert run.records[0].count() <= 4 and run.train[0].count() == 20_000
    assert run.train[0].agg(F.sum("label")).first()[0] == pytest.approx(data.agg(F.sum("label")).first()[0])
    run.close()


def test_samples_are_those_of_sparks_hash(spark):
    marks = [0, -1, 7, 1 << 62, -(1 << 63), *range(1000, 3000)]
    rows = spark.createDataFrame([(m,) for m in marks], "m long")
    for seed, number in ((42, 0), (-3, 17), (1 << 40, 1)):
        hashed = F.pmod(F.xxhash64("m", F.lit(seed), F.lit(number)), F.lit(histograms.SHARES))
        found = {r["m"]: r["h"] for r in rows.select("m", hashed.alias("h")).collect()}
        for share in (1000, histograms.SHARES // 2):
            assert histograms.drawn(np.array(marks), seed, number, share).tolist() == [found[m] < share for m in marks]


@pytest.mark.parametrize("limits", [{}, {"HELD": 1, "TO_DRIVER": 0, "TABLE": 0}])
def test_common_and_rare_features_together(spark, monkeypatch, limits):
    """Bins of common features stand with every row, of rare ones only where they are not 0; deep trees have no table."""
    from pyspark.ml.regression import DecisionTreeRegressor

    for name, value in limits.items():
        monkeypatch.setattr(histograms, name, value)
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(1, 9, 900), rng.integers(-4, 5, 900), *[(rng.random(900) < p) * 1.0 for p in (0.1, 0.05, 0.2, 0.9)]])
    y = x[:, 0] + 5 * x[:, 2] * x[:, 0] - 3 * x[:, 3] + x[:, 1] * x[:, 4] + rng.normal(0, 0.1, 900)
    names = list("abcdef")
    rows = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"]))
    data = train.assemble(rows, names, "y").repartition(3).persist()
    grown = train.boosted_trees(data, data, names, {**STUMP, "n_estimators": 3, "max_depth": 4, "min_child_samples": 5, "max_bins": 16})
    theirs = DecisionTreeRegressor(featuresCol=train.FEATURES, labelCol=train.LABEL, maxDepth=4, maxBins=16, minInstancesPerNode=5).fit(data)
    one, two = [[r["prediction"] for r in m.transform(data).orderBy(train.LABEL).collect()] for m in (grown.model.trees[0], theirs)]
    assert one == pytest.approx(two, rel=1e-9)
    model = grown.model.setPredictionCol("p")
    left = model.transform(data).agg(F.sqrt(F.avg((F.col("label") - F.col("p")) ** 2))).first()[0]
    assert left == pytest.approx(min(r["rmse"] for r in grown.curve.collect()), rel=1e-9)
    data.unpersist()
