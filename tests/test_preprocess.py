import random

import pytest
from pyspark.sql import functions as F

from gavelcast import Settings
from gavelcast.operators import encode, impute
from gavelcast.operators.lookup import LookupTable, attach
from gavelcast.operators.preprocess import Preprocessor


def test_group_then_overall_median(spark):
    data = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), ("c", 10.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, g string, v double")
    groups = impute.fit_group_medians(df, "g", ["v"])
    assert {(r["key"], r["median"]) for r in groups.collect()} == {("a", 2.0), ("c", 10.0)}
    assert impute.fit_global_medians(df, ["v"]).first()["median"] == 3.0
    fitted = impute.fit_medians(df, ["v"], "g", ["v"])
    out = impute.apply(df, fitted, ["g"]).orderBy("i").collect()
    assert [r["v"] for r in out] == [1.0, 3.0, 2.0, 3.0, 3.0, 10.0]
    assert out[4]["g"] == "Unknown"


def test_target_means(spark):
    df = spark.createDataFrame([("p", 10.0), ("p", 20.0), ("q", 60.0), (None, 30.0)], "k string, y double")
    fitted = encode.fit_target(df, ["k"], "y")
    assert fitted.overall == 30.0
    new = spark.createDataFrame([(0, "p"), (1, "q"), (2, None), (3, "z")], "i int, k string")
    out = encode.apply_target(new, fitted).orderBy("i").collect()
    assert [r["k"] for r in out] == [15.0, 60.0, 30.0, 30.0]


def test_null_takes_the_mean_of_the_literal_fill_word(spark):
    df = spark.createDataFrame([("Unknown", 8.0), ("p", 2.0)], "k string, y double")
    fitted = encode.fit_target(df, ["k"], "y")
    out = encode.apply_target(spark.createDataFrame([(None,)], "k string"), fitted)
    assert out.first()["k"] == 8.0


@pytest.fixture
def letters(spark):
    values = ["A"] * 3 + ["B"] * 2 + ["C", None]
    return spark.createDataFrame([(v,) for v in values], "c string")


def onehot(spark, encoding, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    out = encode.apply_onehot(df, encoding).orderBy("i").drop("i")
    return out.columns, ["".join(map(str, r)) for r in out.collect()]


def test_onehot_reference_nulls(spark, letters):
    encoding = encode.fit_onehot(letters, ["c"], rare_below=2)
    names, got = onehot(spark, encoding, ["A", "B", "C", None, "Z"])
    assert names == ["c_B", "c_Other", "c_Unknown"]
    assert got == ["000", "100", "010", "010", "010"]


def test_onehot_unknown_nulls(spark, letters):
    encoding = encode.fit_onehot(letters, ["c"], rare_below=2, null_as="unknown")
    _, got = onehot(spark, encoding, ["A", "B", "C", None, "Z"])
    assert got == ["000", "100", "010", "001", "010"]


def test_onehot_is_row_wise(spark, letters):
    encoding = encode.fit_onehot(letters, ["c"], rare_below=2)
    assert onehot(spark, encoding, ["B"])[1] == ["100"]


def test_onehot_without_rare_levels(spark):
    df = spark.createDataFrame([(v,) for v in ["A"] * 3 + ["B"] * 3], "c string")
    encoding = encode.fit_onehot(df, ["c"], rare_below=2)
    assert onehot(spark, encoding, [None, "Z"]) == (["c_B"], ["0", "0"])


def test_onehot_literal_fill_words(spark):
    df = spark.createDataFrame([(v,) for v in ["Unknown"] * 3 + ["Other"] * 3 + ["A"] * 3], "c string")
    encoding = encode.fit_onehot(df, ["c"], rare_below=2)
    names, got = onehot(spark, encoding, ["Unknown", None, "Other", "A", "new"])
    assert names == ["c_Other", "c_Unknown"]
    assert got == ["01", "01", "10", "00", "10"]


def test_rare_and_counts(spark, letters):
    counts = encode.rare_levels(encode.level_counts(letters, ["c"]), 2)
    assert {(r["level"], r["n"], r["is_rare"]) for r in counts.collect()} == {
        ("A", 3, 0), ("B", 2, 0), ("C", 1, 1)}


def test_large_lookup_equals_small_lookup(spark):
    """Hot keys, cold keys, unseen keys and nulls give the same through both joins."""
    rng = random.Random(5)
    keys = ["hot"] * 300 + [f"k{rng.randint(0, 60)}" for _ in range(300)] + [None] * 200 + ["new"] * 20
    df = spark.createDataFrame(list(enumerate(keys)), "i int, k string").repartition(5)
    seen = {}
    for k in keys[:600]:
        seen[k] = seen.get(k, 0) + 1
    # Out of 60,000 rows seen, only the key with 300 is hot.
    state = [(k, float(len(k) + n), n) for k, n in seen.items()]
    table = spark.createDataFrame(state, "key string, m double, n bigint")
    small = attach(df, "k", LookupTable(table, 10, 600), ["m"])
    large = attach(df, "k", LookupTable(table, 10, 60_000, broadcast_limit=0), ["m"])
    want = {(r["i"], r["k"], r["m"]) for r in small.collect()}
    assert want == {(i, k, float(len(k) + seen[k]) if k in seen else None) for i, k in enumerate(keys)}
    assert {(r["i"], r["k"], r["m"]) for r in large.collect()} == want
    assert large.columns == ["i", "k", "m"]


SETTINGS = Settings(
    target="price", log_target="log_price", group="g", dropped=("id",), group_imputed=("hours",),
    target_encoded=("model",), one_hot=("band",), rare_below=3, price_bounds=(10.0, 90.0))


@pytest.fixture
def sales(spark):
    rng = random.Random(11)
    data = []
    for i in range(120):
        data.append((i, float(rng.randint(1, 100)), rng.choice(["x", "y", None]),
                     rng.choice([None, 1.0, 5.0, 9.0]), rng.choice(["m1", "m2", "m.3", None]),
                     rng.choice(["hi", "lo", "lo", None]) if i else "odd", rng.randint(1, 4)))
    return spark.createDataFrame(
        data, "id int, price double, g string, hours double, model string, band string, size int")


def test_needs_a_fit(sales):
    with pytest.raises(RuntimeError):
        Preprocessor(SETTINGS).transform(sales)


def test_transform_against_plain_python(spark, sales):
    prep = Preprocessor(SETTINGS)
    out = prep.fit_transform(sales)
    assert prep.final_columns == ["hours", "model", "size", "band_Unknown", "band_hi", "band_lo"]
    assert out.columns == [*prep.final_columns, "price", "log_price"]

    raw = [r.asDict() for r in sales.collect()]

    def median(values):
        values = sorted(values)
        n = len(values)
        return (values[(n - 1) // 2] + values[n // 2]) / 2

    overall = median([r["hours"] for r in raw if r["hours"] is not None])
    by_group = {g: median([r["hours"] for r in raw if r["g"] == g and r["hours"] is not None])
                for g in ("x", "y")}
    mean = sum(r["price"] for r in raw) / len(raw)
    carried = prep.transform(sales, keep=["id"]).collect()
    assert len(carried) == 120
    for got in carried:
        r = raw[got["id"]]
        hours = r["hours"] if r["hours"] is not None else by_group.get(r["g"], overall)
        same = [q["price"] for q in raw if q["model"] == r["model"]]
        encoded = sum(same) / len(same) if r["model"] is not None else mean
        assert got["hours"] == hours
        assert got["model"] == pytest.approx(encoded)
        assert (got["band_hi"], got["band_lo"], got["band_Unknown"]) == (
            int(r["band"] == "hi"), int(r["band"] == "lo"), 0)
        assert got["price"] == r["price"]
    assert out.agg(F.min("price"), F.max("price")).first() == (10.0, 90.0)


def test_one_row_equals_full_frame(sales):
    prep = Preprocessor(SETTINGS).fit(sales)
    full = {r["id"]: r for r in prep.transform(sales, keep=["id"]).collect()}
    for i in (0, 3, 77):
        assert prep.transform(sales.where(F.col("id") == i), keep=["id"]).first() == full[i]


def test_missing_and_extra_columns(sales):
    prep = Preprocessor(SETTINGS).fit(sales)
    changed = sales.drop("band").withColumn("extra", F.lit(1))
    out = prep.transform(changed)
    assert out.columns == [*prep.final_columns, "price"]
    assert prep.missing_features(changed) == ["band_Unknown", "band_hi", "band_lo"]
    assert out.agg(F.sum("band_lo")).first()[0] == 0


def test_row_order_does_not_matter(sales):
    one = Preprocessor(SETTINGS).fit(sales).transform(sales, keep=["id"])
    two = Preprocessor(SETTINGS).fit(sales.orderBy(F.desc("id"))).transform(
        sales.repartition(6), keep=["id"])
    rounded = [F.round(n, 9).alias(n) for n in one.columns]
    assert set(one.select(rounded).collect()) == set(two.select(rounded).collect())


def test_integer_levels_survive_imputation(spark):
    df = spark.createDataFrame([(3, 10.0), (3, 20.0), (4, 40.0), (None, 50.0)], "s int, y double")
    settings = Settings(target="y", log_target="ly", target_encoded=("s",), one_hot=(),
                        group_imputed=(), dropped=())
    out = Preprocessor(settings).fit(df).transform(df).orderBy("y").collect()
    # The missing value is imputed with the median 3 before the lookup.
    assert [r["s"] for r in out] == [15.0, 15.0, 40.0, 15.0]
