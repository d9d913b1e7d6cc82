import json
import os

import pytest
from pyspark.errors import AnalysisException

from gavelcast import Settings
from gavelcast.operators import evaluate, tune
from gavelcast.plans import workflow
from gavelcast.sources import artifacts, csv


def write(tmp_path, text, name="sales.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_headers_and_missing_words(spark, tmp_path):
    path = write(tmp_path, ',Screen Size,Screen Size,A.b,N\n0,NA,x,1,None\n1,,y,2,5\n')
    df = csv.read_sales(spark, path)
    assert df.columns == ["Unnamed: 0", "Screen Size", "Screen Size.1", "A.b", "N"]
    assert dict(df.dtypes) == {
        "Unnamed: 0": "bigint", "Screen Size": "double", "Screen Size.1": "string",
        "A.b": "bigint", "N": "double"}
    assert [tuple(r) for r in df.collect()] == [(0, None, "x", 1, None), (1, None, "y", 2, 5.0)]


def test_header_names_stay_unique():
    assert csv.mangle_headers(["a", "a", "a.1", None, ""]) == [
        "a", "a.2", "a.1", "Unnamed: 3", "Unnamed: 4"]


def test_text_stays_text(spark, tmp_path):
    path = write(tmp_path, 'Model Series,Usage Band,q\n7,None or Unspecified,"say ""hi"", ok"\n8,n/a,1\n')
    df = csv.read_sales(spark, path)
    assert dict(df.dtypes) == {"Model Series": "string", "Usage Band": "string", "q": "string"}
    assert [tuple(r) for r in df.collect()] == [
        ("7", "None or Unspecified", 'say "hi", ok'), ("8", None, "1")]


def test_given_types_skip_inference(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,x\nbad,2\n")
    df = csv.read_sales(spark, path, types={"a": "double"})
    assert [tuple(r) for r in df.collect()] == [(1.0, "x"), (None, "2")]


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        csv.read_sales(spark, str(tmp_path / "none.csv"))


def test_nan_becomes_null(spark):
    df = csv.normalize_nulls(spark.sql("select double('NaN') as a, 'nan' as b, 'x' as c"))
    assert tuple(df.first()) == (None, None, "x")


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("ridge", 0.5), ("trees", 0.9)], "Model string, R2 double")
    path = csv.write_report(df, str(tmp_path / "report"))
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert sorted(map(tuple, back.collect())) == [("ridge", 0.5), ("trees", 0.9)]


def test_params_round_trip(spark, tmp_path):
    trials = spark.createDataFrame([(0, 0.3, 5, '{"a": 1}'), (1, 0.2, 4, '{"a": 2}')], tune.TRIALS_SCHEMA)
    path = artifacts.save_params(tune.best_trial(trials), str(tmp_path / "params"))
    assert artifacts.load_params(spark, path) == {"a": 2}


HEADER = ",Sales ID,Sales Price,Sales date,Year Made,MachineHours CurrentMeter,Product Group," \
         "Product Class Description,Model Description,Screen Size,Screen Size,Usage Band,Model Series"


@pytest.fixture(scope="module")
def outcome(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    lines = [HEADER]
    for i in range(900):
        size, model = i * 7 % 40 + 1, i * 13 % 9
        price = 8000 + 900 * size + 2500 * model + i % 17 * 40
        group = ["WL", "TTT", "BL", ""][i % 4]
        year = 1000 if i % 23 == 0 else 1970 + i % 40
        hours = "" if i % 3 else str(100 + i)
        lines.append(f"{i},{i + 5000},{price},11/{i % 28 + 1}/200{i % 9} 0:00,{year},{hours},{group},"
                     f"Loader - {size}.0 to {size + 5}.0 Horsepower,M{model},,24 inch,"
                     f"{['Low', 'High', 'Medium', 'NA'][i % 4]},{i % 5}")
    source = folder / "sales.csv"
    source.write_text("\n".join(lines) + "\n")
    df = csv.read_sales(spark, str(source))
    models = {"ridge": {"alpha": 1.0},
              "boosted_trees": {"n_estimators": 20, "learning_rate": 0.3, "max_depth": 4, "patience": 6}}
    output = str(folder / "out")
    return df, workflow.run(df, Settings(), models, output), output


def test_run_reports(outcome):
    _, got, _ = outcome
    assert got.run.best().key == "boosted_trees"
    scores = {(r["split"], r["model"]): r["R2"] for r in got.scores.collect()}
    assert scores["test", "boosted_trees"] > scores["test", "ridge"] > 0.5
    assert sum(r["count"] for r in got.segments.collect()) > 90
    assert {r["metric"] for r in got.summary.collect()} == {"MAE", "RMSE", "R2", "MAPE"}
    assert len(got.tables) == 13
    for name, table in got.tables.items():
        assert table.count() > 0, name


def test_features_exclude_ids_and_targets(outcome):
    features = outcome[1].preprocessor.final_columns
    assert "Horsepower" in features and "Is_Year_Placeholder" in features
    assert "Screen Size_1" in features and "Usage Band_Low" in features
    assert not {"Sales ID", "Unnamed: 0", "Sales Price", "Model Series"} & set(features)


def test_scoring_from_disk(spark, outcome):
    df, got, output = outcome
    scored = workflow.score(df, f"{output}/preprocessor", f"{output}/best_model", ["Sales ID"])
    assert scored.count() == 900
    prices = df.selectExpr("`Sales ID`", "double(`Sales Price`) as y")
    joined = scored.withColumnRenamed("predicted_price", "prediction").join(prices, "Sales ID")
    assert evaluate.metrics(joined).first()["R2"] > 0.8
    model, metadata = artifacts.load_best(spark, f"{output}/best_model")
    assert metadata["model"]["key"] == "boosted_trees" and metadata["model"]["rounds"] >= 1
    assert metadata["model"]["features"] == got.preprocessor.final_columns and metadata["saved_at"].endswith("+00:00")
    one = df.where("`Sales ID` = 5003")
    alone = workflow.score(one, f"{output}/preprocessor", f"{output}/best_model", ["Sales ID"]).first()
    whole = scored.where("`Sales ID` = 5003").first()
    assert alone == whole


def test_reports_on_disk(spark, outcome):
    output = outcome[2]
    board = csv.read_sales(spark, f"{output}/reports/test_evaluation")
    assert board.columns == ["Model", "MAE", "RMSE", "R2", "MAPE"]
    assert [r["Model"] for r in board.collect()] == ["boosted_trees", "ridge"]


def test_tuning(spark, outcome, tmp_path):
    space = {"learning_rate": (0.1, 0.4, "log"), "max_depth": (2, 3, "int")}
    trials, best = workflow.tune_boosting(
        outcome[0], Settings(), str(tmp_path), n_trials=2, space=space, trees=3, patience=2)
    assert trials.count() == 2
    saved = artifacts.load_params(spark, f"{tmp_path}/best_params")
    assert saved == json.loads(best.first()["params"]) and set(saved) == set(space)


def test_load_and_split(spark, tmp_path):
    lines = "Sales ID,Sales Price\n" + "".join(f"{i},{i * 10}\n" for i in range(100))
    parts = workflow.load_and_split(spark, write(tmp_path, lines), exact=True)
    assert {k: v.count() for k, v in parts.items()} == {"train": 70, "val": 15, "test": 15}
