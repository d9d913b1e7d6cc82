import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from gavelcast.functions import quantiles as quantiles_module
from gavelcast.functions.quantiles import quantiles, values_at_ranks

PROBS = [0.0, 0.2, 0.4, 0.5, 0.6, 0.8, 1.0]


def expected(values, prob):
    values = sorted(values)
    position = prob * (len(values) - 1)
    low, high = math.floor(position), math.ceil(position)
    return values[low] + (values[high] - values[low]) * (position - low)


def check(spark, data, **limits):
    df = spark.createDataFrame(data, "k string, v double").repartition(3)
    got = {(r["key"], r["prob"]): r["quantile"]
           for r in quantiles(df, ["v"], PROBS, F.col("k"), **limits).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == {(k, p) for k in groups for p in PROBS}
    for (k, p), value in got.items():
        assert value == pytest.approx(expected(groups[k], p), rel=1e-12, abs=1e-12), (k, p)


@pytest.mark.parametrize("limits", [{}, {"final_rows": 20, "bins": 16}])
def test_matches_sorting(spark, limits):
    rng = random.Random(1)
    data = [("hot", rng.gauss(0, 1)) for _ in range(400)]
    data += [("whole", float(rng.randint(1, 9))) for _ in range(150)]
    data += [("tied", 7.0)] * 40 + [("one", 3.0), ("empty", None)]
    data += [("far", 10.0 ** e) for e in (-200, -3, 0, 1, 2, 3, 200)] * 5
    check(spark, data, **limits)


def test_extreme_ranges_end(spark):
    data = [("a", v) for v in (-1.7e308, 1.7e308, 0.0, 1.0, 1.0, 2.0, 5e-324, 3.0)]
    check(spark, data, final_rows=2, bins=3)


def test_infinities_end(spark):
    data = [("a", v) for v in [-math.inf, math.inf] + [float(i) for i in range(21)]]
    df = spark.createDataFrame(data, "k string, v double")
    got = quantiles(df, ["v"], [0.5], final_rows=4, bins=6).first()["quantile"]
    assert got == 10.0


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_any_values(spark, values):
    check(spark, [("g", v) for v in values], final_rows=6, bins=6)


def test_missing_values_are_skipped(spark):
    data = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0)]
    df = spark.createDataFrame(data, "k string, v double")
    assert quantiles(df, ["v"], [0.5], F.col("k")).first()["quantile"] == 2.0


def test_columns_share_the_passes(spark):
    rng = random.Random(2)
    data = [(rng.random(), float(i % 5), None) for i in range(200)]
    df = spark.createDataFrame(data, "a double, `b.c` double, d double")
    got = {r["feature"]: r["quantile"]
           for r in quantiles(df, ["a", "b.c", "d"], [0.5], final_rows=30, bins=8).collect()}
    assert got == {"a": pytest.approx(expected([r[0] for r in data], 0.5)), "b.c": 2.0}


def test_ranks_equal_sorted_positions(spark):
    values = np.random.default_rng(3).random(500).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = [0, 17, 349, 499]
    got = values_at_ranks(df, "v", lambda n: ranks if n == 500 else [], final_rows=10, bins=8)
    assert got == {r: sorted(values)[r] for r in ranks}


def test_rows_are_not_shuffled_to_meet_their_ranges(spark, capsys):
    """The passes over the rows exchange partial counts only, whatever the planner thinks of the sizes."""
    df = spark.range(5000).select(F.rand(3).alias("v"))
    search = quantiles_module._Search(df, ["v"], None, 100, 8)
    search._inside(search.totals).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "hashpartitioning" not in plan
