import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from gavelcast import Settings
from gavelcast.operators import conjugate, encode, evaluate, sparse, train
from gavelcast.operators.preprocess import Preprocessor
from gavelcast.plans import workflow

VALUES = ["A"] * 3 + ["B"] * 2 + ["C", None, "é", "é", "Z", "Z", "Z"]


def as_columns(spark, df, encoding, names):
    out = encode.apply_onehot(df, encoding).orderBy("i")
    return out.columns[1:], [[float(x) for x in r[1:]] for r in out.collect()]


def as_vectors(df, index):
    names = [r["feature"] for r in index.names().orderBy("position").collect()]
    return names, [r["features"].toArray().tolist() for r in sparse.assembled(df, index, []).orderBy("i").collect()]


@pytest.mark.parametrize("null_as", ["reference", "unknown"])
@pytest.mark.parametrize("values", [VALUES, VALUES + ["Other"] * 2, VALUES + ["Unknown"] * 2, ["Unknown"] + VALUES, ["A", "A"], ["A", "A", None]])
def test_vectors_equal_columns(spark, values, null_as):
    rows = spark.createDataFrame([(v, v and v.lower()) for v in values], "c string, d string")
    new = spark.createDataFrame(
        [(i, v, v and v.lower()) for i, v in enumerate([*dict.fromkeys(values), "new", "Other", "Unknown", None])], "i int, c string, d string")
    columns = encode.fit_onehot(rows, ["c", "d"], 2, null_as)
    index = sparse.fit_levels(rows, ["c", "d", "absent"], 2, null_as)
    if not index.width:
        assert columns.columns() == []
        return
    assert as_vectors(new, index) == as_columns(spark, new, columns, ["c", "d"])


def test_positions_run_through_many_ranges(spark):
    rows = spark.range(5000).select(F.format_string("l%05d", "id").alias("c"), (F.col("id") % 7).cast("string").alias("d"))
    index = sparse.fit_levels(rows, ["c", "d"], 1)
    state = index.state.orderBy("feature", "position").collect()
    assert [(r["feature"], r["position"]) for r in state] == [("c", i) for i in range(5000)] + [("d", i) for i in range(7)]
    assert [r["level"] for r in state[:5000]] == [f"l{i:05d}" for i in range(5000)]


def test_no_level_is_named_on_the_driver(spark):
    """The frame's metadata had a name per entry, millions of them in wide tables."""
    rows = spark.range(6000).select((F.col("id") % 3000).cast("string").alias("c"), F.col("id").cast("double").alias("x"), F.col("id").alias("i"))
    index = sparse.fit_levels(rows, ["c"], 2)
    made = sparse.assembled(rows, index, ["x"])
    assert made.schema["features"].metadata == {} and len(made.schema.json()) < 2000
    vectors = {r["i"]: r["features"] for r in made.where("i in (0, 1, 10, 5999)").collect()}
    assert vectors[0] == SparseVector(3000, {}) and vectors[1] == SparseVector(3000, {0: 1.0, 1: 1.0})
    last = sorted(map(str, range(3000))).index("2999")
    assert vectors[10] == SparseVector(3000, {0: 10.0, 2: 1.0}) and vectors[5999] == SparseVector(3000, {0: 5999.0, last: 1.0})


def test_numbers_pass_whole_and_missing_ones_raise(spark):
    values = [1 / 3, -0.1, 5e-324, 1.7e308, float("inf"), 0.0]
    rows = spark.createDataFrame([("a" if i % 2 else "b", v) for i, v in enumerate(values)], "c string, x double")
    index = sparse.fit_levels(rows, ["c"], 1)
    made = sparse.assembled(rows, index, ["x"])
    assert sorted(r["features"].toArray()[0] for r in made.collect()) == sorted(values)
    for bad in (None, float("nan")):
        with pytest.raises(Exception, match="missing in a row"):
            sparse.assembled(spark.createDataFrame([("a", bad)], "c string, x double"), index, ["x"]).collect()


def test_two_hundred_thousand_levels(spark):
    """Fitted and applied without a column or a driver entry per level."""
    n = 200_000
    rows = spark.range(2 * n).select((F.col("id") % n).cast("string").alias("c"), F.col("id").alias("i"))
    index = sparse.fit_levels(rows, ["c"], 2)
    assert index.width == n - 1
    made = sparse.assembled(rows.where("i % 1000 = 7"), index, [])
    entries = {int(r["c"]): r["features"] for r in made.collect()}
    order = {level: k for k, level in enumerate(sorted(map(str, range(n))))}
    assert len(entries) == 200 * 2 / 2
    for level, vector in entries.items():
        assert isinstance(vector, SparseVector) and vector.size == n - 1
        assert vector.indices.tolist() == [order[str(level)] - 1] and vector.values.tolist() == [1.0]


SETTINGS = dict(target="y", log_target="ly", group="", group_imputed=(), target_encoded=(), one_hot=("c", "d"), rare_below=3,
                price_bounds=(0.0, 1e9), split_key="k", dropped=("k",))


def sales(spark, n=600, levels=40):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % levels).cast("string").alias("c"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("d"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 7 % 31).cast("double")).alias("x"),
        (1000.0 + F.col("id") % levels * 50 + F.col("id") * 7 % 31).alias("y"))


def wide(monkeypatch):
    monkeypatch.setattr(encode, "COLUMN_LEVELS", 10)


def test_a_wide_preprocessor_gives_the_same_vectors(spark, monkeypatch):
    rows = sales(spark)
    narrow = Preprocessor(Settings(**SETTINGS)).fit(rows)
    wide(monkeypatch)
    broad = Preprocessor(Settings(**SETTINGS)).fit(rows)
    assert broad.wide and not narrow.wide
    with pytest.raises(ValueError, match="vectors"):
        broad.transform(rows)
    with pytest.raises(ValueError, match="sparse vector"):
        encode.fit_onehot(rows, ["c", "d"], 3)
    new = sales(spark, 700, 45)
    a, b = [{r["k"]: (r["features"].toArray().tolist(), r["y"]) for r in p.vectors(new, keep=["k", "c"]).collect()} for p in (narrow, broad)]
    assert a == b and len(a) == 700
    names = [[r["feature"] for r in p.feature_names(spark).orderBy("position").collect()] for p in (narrow, broad)]
    assert names[0] == names[1]


def test_a_wide_run_saves_and_scores(spark, monkeypatch, tmp_path):
    models = {"ridge": {"alpha": 1.0}}
    narrow = workflow.run(sales(spark), Settings(**SETTINGS), models, with_tables=False)
    wide(monkeypatch)
    monkeypatch.setattr(train, "NORMAL_FEATURES", 5)
    out = workflow.run(sales(spark), Settings(**SETTINGS), models, output=str(tmp_path / "out"))
    a, b = [{(r["split"], r["model"]): r["RMSE"] for r in o.scores.collect()} for o in (narrow, out)]
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)
    top = out.tables["feature_importance"].collect()
    assert all(r["feature"].startswith(("c_", "d_", "x")) for r in top) and len(top) == 15
    scored = workflow.score(sales(spark, 50), str(tmp_path / "out/preprocessor"), str(tmp_path / "out/best_model"), ["k"])
    assert scored.count() == 50 and scored.where("predicted_price is null").isEmpty()


def test_conjugate_gradients_equal_the_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) * [1.0, 30.0, 0.01] + [0.0, 2000.0, 1.0]
    y = 9 + x @ [0.5, -0.02, 20.0] + rng.normal(0, 0.1, 500)
    names = ["a", "b", "c"]
    rows = train.assemble(spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double"), names, "y").persist()
    for alpha in (0.0, 1.0, 50.0):
        model = conjugate.ridge(rows, train.FEATURES, train.LABEL, alpha)
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert model.coefficients.toArray().tolist() == pytest.approx(w.tolist(), rel=1e-8, abs=1e-8)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-8)
    rows.unpersist()


def test_ridge_with_twenty_thousand_features(spark, tmp_path):
    """Levels of equal count: a ridge on dummies alone shrinks each level's mean, in closed form."""
    n, copies, alpha = 20_001, 3, 2.0
    rows = spark.range(n * copies).select(F.format_string("%05d", F.col("id") % n).alias("c"), ((F.col("id") % n) % 7 + F.col("id") % 2).cast("double").alias("y"))
    index = sparse.fit_levels(rows, ["c"], 1)
    data = sparse.assembled(rows, index, []).select(F.col("features").alias(train.FEATURES), F.col("y").alias(train.LABEL)).persist()
    fitted = train.ridge(data, [], alpha)
    assert fitted.model.numFeatures == 20_000
    model = fitted.model
    # The free intercept makes the residuals sum to 0; each dummy's weight is its residual sum over alpha.
    left = data.select(train.LABEL, F.col(train.FEATURES))
    scored = fitted.predict(left, "p").agg(F.sum(F.col(train.LABEL) - F.col("p")).alias("r")).first()["r"]
    assert abs(scored) < 1e-6
    means = {int(r["c"]): r["s"] for r in rows.groupBy("c").agg(F.sum("y").alias("s")).collect()}
    weights = model.coefficients.toArray()
    for level in (1, 2, 77, 19_999):
        assert weights[level - 1] == pytest.approx((means[level] - copies * model.intercept) / (copies + alpha), abs=1e-8)
    fitted.stages().write().save(str(tmp_path / "m"))
    top = evaluate.feature_importance(spark, model, index.names(), 5).collect()
    assert len(top) == 5 and top[0]["importance"] == pytest.approx(abs(weights).max())
    data.unpersist()


def test_unconverged_and_empty(spark):
    rows = train.assemble(spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, 5.0), (4.0, 9.0, 1.0)], "a double, b double, y double"), ["a", "b"], "y")
    with pytest.warns(UserWarning, match="steps"):
        conjugate.ridge(rows, train.FEATURES, train.LABEL, 1.0, steps=1)
    with pytest.raises(ValueError, match="no rows"):
        conjugate.ridge(rows.where("false"), train.FEATURES, train.LABEL, 1.0)
    constant = train.assemble(spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 1.0, 5.0)], "a double, b double, y double"), ["a", "b"], "y")
    assert conjugate.ridge(constant, train.FEATURES, train.LABEL, 0.0).coefficients.toArray().tolist() == pytest.approx([0.0, -2.0])
