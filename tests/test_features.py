import math

import pytest
from pyspark.sql import functions as F

from gavelcast import Settings
from gavelcast.functions import columns as fx
from gavelcast.operators import schema
from gavelcast.operators.features import engineer
from gavelcast.params import TEXT_PATTERNS


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def result(df, *exprs):
    out = df.orderBy("i").select(*exprs).collect()
    return [tuple(r) if len(r) > 1 else r[0] for r in out]


def test_placeholder_and_bound(spark):
    df = column(spark, [1000, 1949, 1950, None], "int")
    v = F.col("v")
    assert result(df, fx.flag_equals(v, 1000)) == [1, 0, 0, 0]
    assert result(df, fx.null_below(v, 1950)) == [None, None, 1950, None]


def test_numbers_from_text(spark):
    texts = ["150.0 to 175.0 Horsepower", "20 to 30 Metric Tons", "Unidentified", None,
             "8 to 9 Ft Standard Digging Depth"]
    found = fx.extract_numbers(F.col("v"), TEXT_PATTERNS)
    got = result(column(spark, texts, "string"), *found.values())
    assert list(found) == ["Horsepower", "Weight_Tons", "Digging_Depth_Ft"]
    assert got == [(150.0, None, None), (None, 20.0, None), (None, None, None),
                   (None, None, None), (None, None, 8.0)]


def test_dates_and_age(spark):
    df = spark.createDataFrame(
        [(0, "2009-05-14"), (1, "x"), (2, None), (3, "11/16/2006 0:00"), (4, "2004-12-31 10:00:00")],
        "i int, `Sales date` string").withColumn("Year Made", F.lit(2000))
    out = engineer(df).orderBy("i").select(
        "Sale_Year", "Sale_Month", "Sale_Quarter", "Machine_Age").collect()
    assert [tuple(r) for r in out] == [
        (2009, 5, 2, 9), (None,) * 4, (None,) * 4, (2006, 11, 4, 6), (2004, 12, 4, 4)]


def test_engineer_skips_absent_columns_and_flags_hours(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "`MachineHours CurrentMeter` double")
    out = engineer(df)
    assert out.columns == ["MachineHours CurrentMeter", "Has_Hours"]
    assert sorted(r["Has_Hours"] for r in out.collect()) == [0, 1]


def test_engineer_takes_timestamps_as_they_are(spark):
    df = spark.sql("select timestamp'2010-08-01 00:00:00' as d")
    out = engineer(df, Settings(sale_date="d")).first()
    assert (out["Sale_Year"], out["Sale_Month"], out["Sale_Quarter"]) == (2010, 8, 3)


def test_clip_keeps_missing(spark):
    df = column(spark, [5000.0, 50000.0, 200000.0, None], "double")
    clipped = fx.clip(F.col("v"), 6100, 107500)
    assert result(df, clipped) == [6100.0, 50000.0, 107500.0, None]
    logged = result(df, fx.log_target(clipped))
    assert logged[0] == pytest.approx(8.716208, abs=1e-6) and logged[3] is None
    back = result(df, fx.to_original_scale(fx.log_target(F.col("v"))))
    assert back[1] == pytest.approx(50000.0)


def test_percent_error_of_zero_is_missing(spark):
    df = column(spark, [0.0, 50.0], "double")
    assert result(df, fx.percent_error(F.col("v"), F.lit(40.0))) == [None, 20.0]


def test_fill_zero_leaves_text_alone(spark):
    df = spark.createDataFrame([(None, None, 2.0)], "a int, t string, `x.y` double")
    assert tuple(schema.fill_zero(df).first()) == (0, None, 2.0)


def test_classify_and_drop(spark):
    df = spark.sql("select 1 as id, 2.0D as hours, 'a' as band, 'b' as note, "
                   "timestamp'2020-01-01 00:00:00' as at, true as flag, 9.0D as price")
    assert schema.classify(df, ["price", "id"]) == (["hours"], ["band", "note"])
    left = schema.drop_columns(df, ["id", "not there"], encoded=["band"])
    assert left.columns == ["hours", "band", "flag", "price"]


@pytest.mark.parametrize("given, wanted", [
    (["Screen Size.1"], ["Screen Size_1"]),
    (["a[b]"], ["a_b_"]),
    (["a.b", "a:b"], ["a_b", "a_b_1"]),
    (["a.b", "a:b", "a_b_1"], ["a_b", "a_b_2", "a_b_1"]),
])
def test_safe_names(given, wanted):
    assert schema.safe_names(given) == wanted


def test_sanitize_names_renames_by_position(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `a:b` int")
    out = schema.sanitize_names(df)
    assert out.columns == ["a_b", "a_b_1"] and tuple(out.first()) == (1, 2)


def test_align(spark):
    df = spark.createDataFrame([(3, 1, 9, 5.0)], "c int, a int, z int, y double")
    out, added = schema.align(df, ["a", "b", "c"], ["y"])
    assert out.columns == ["a", "b", "c", "y"] and added == ["b"]
    assert tuple(out.first()) == (1, 0, 3, 5.0)


def test_separate(spark):
    x, y = schema.separate(spark.createDataFrame([(1, 2.0)], "a int, `p q` double"), "p q")
    assert x.columns == ["a"] and y.columns == ["p q"]


def test_log_of_expm1_is_identity():
    assert math.expm1(math.log1p(12.5)) == pytest.approx(12.5)
