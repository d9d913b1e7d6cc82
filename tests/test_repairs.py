"""Inputs that the test tables do not contain."""

import datetime

import pytest
from pyspark.sql import functions as F

from gavelcast.functions import columns as fx
from gavelcast.operators import encode, plotdata
from gavelcast.operators.preprocess import Preprocessor
from gavelcast.params import Settings
from gavelcast.plans import sale, workflow
from gavelcast.sources import csv


def test_a_density_has_every_grid_point(spark):
    rows = spark.range(1000).select((F.col("id") / 1000).alias("v")).unionByName(spark.createDataFrame([(1e6,)], "v double"))
    got = plotdata.kde(rows, "v").collect()
    assert sorted(r["point"] for r in got) == list(range(500))
    assert sum(r["density"] == 0 for r in got) > 100 and all(r["density"] >= 0 for r in got)


def test_scatter_counts_values_of_any_sign(spark):
    rows = spark.createDataFrame([(-5.0, -9.0), (-1.0, -2.0), (-8.0, -7.0)], "y double, prediction double")
    cells = {(r["y_bin"], r["prediction_bin"]): r["count"] for r in plotdata.scatter(rows, 10).collect()}
    assert sum(cells.values()) == 3 and len(cells) == 3 and all(0 <= i < 10 for cell in cells for i in cell)


def test_big_whole_keys_are_levels_of_their_own(spark):
    rows = spark.createDataFrame([(9007199254740992, 3.0), (9007199254740993, 3.5)], "k long, d double")
    assert [r[0] for r in rows.select(fx.level_text(rows, "k")).collect()] == ["9007199254740992", "9007199254740993"]
    assert [r[0] for r in rows.select(fx.level_text(rows, "d")).collect()] == ["3", "3.5"]


@pytest.mark.parametrize("text", ["2006-11-16", "2006-11-16 00:00:00", "2006-11-16T00:00:00", "2006-11-16T00:00:00.000", "2006-11-16 00:00:00.0",
                                  "16-Nov-2006", "16 Nov 2006", "Nov 16, 2006", "11/16/2006", "11/16/2006 0:00", "2006-11-16T00:00"])
def test_dates(spark, text):
    rows = spark.createDataFrame([(text,), ("no date",), (None,)], "d string")
    got = [r[0] for r in rows.select(fx.parse_date(F.col("d"), Settings().date_formats)).collect()]
    assert got == [datetime.datetime(2006, 11, 16), None, None]


def test_nan_of_other_sources_is_missing(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(i, "a" if i % 2 else "b", nan if i == 3 else 100.0 * i) for i in range(40)], "k long, g string, p double")
    s = Settings(target="p", log_target="lp", group="", group_imputed=(), target_encoded=("g",), one_hot=(), split_key="k", dropped=("k",))
    prepared = workflow.prepare(rows, s)
    assert prepared.where(F.isnan("p")).isEmpty() and prepared.where("p is null").count() == 1
    means = encode.fit_target(prepared, ["g"], "p")
    assert means.overall == means.overall


def test_lines_are_not_shuffled_for_customers(spark):
    """In the plan, the join with customers has no lines below it."""
    rows = sale.sale(spark, "/root/testdata/sf0.001")
    lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Join Inner" in line and "(o_custkey" in line)
    below = lines[at + 1:next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))]
    assert any("c_custkey" in line for line in below) and not any("l_orderkey" in line for line in below)


def test_dropped_columns_need_not_be_stored(spark):
    s, rows = sale.SALE_SETTINGS, sale.sale(spark, "/root/testdata/sf0.001")
    whole, narrow = workflow.prepare(rows, s), workflow.prepare(rows, s, keep=("l_orderkey", "l_linenumber"))
    assert set(whole.columns) - set(narrow.columns) == {"l_partkey", "c_name", "n_name", "Sale_Date"}
    one, two = (Preprocessor(s).fit(workflow.splits(p)["train"]).transform(
        workflow.splits(p)["test"], keep=["l_orderkey", "l_linenumber"]).drop(*s.target_encoded) for p in (whole, narrow))
    assert one.columns == two.columns and one.count() == two.count()
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def write(path, **files):
    path.mkdir(exist_ok=True)
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_quoted_line_breaks_are_found(spark, tmp_path):
    path = write(tmp_path / "q", a='k,t\n1,"x\ny"\n2,z\n')
    assert [tuple(r) for r in csv.read_sales(spark, path).orderBy("k").collect()] == [(1, "x\ny"), (2, "z")]
    assert not csv.breaks_lines(spark, write(tmp_path / "p", a='k,t\n1,"x, ""y"""\n'))


def test_files_may_order_columns_differently(spark, tmp_path):
    path = write(tmp_path / "o", one="a,b\n1,x\n", two="b,a\ny,2\n", three="a,b\n3,z\n")
    assert sorted(tuple(r) for r in csv.read_sales(spark, path).select("a", "b").collect()) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError, match="different columns"):
        csv.read_sales(spark, write(tmp_path / "d", one="a,b\n1,x\n", two="a,c\n1,y\n"))


def test_rows_of_other_widths(spark, tmp_path):
    assert [tuple(r) for r in csv.read_sales(spark, write(tmp_path / "s", a="a,b\n1\n")).collect()] == [(1, None)]
    with pytest.raises(Exception, match="more than 2 fields"):
        csv.read_sales(spark, write(tmp_path / "w", a="a,b\n1,x,9\n")).collect()
