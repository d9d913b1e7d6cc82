import pytest
from pyspark.sql import functions as F

from gavelcast.operators.split import exact_split, hash_split, split_sizes


def sides(df):
    return {r["id"]: r["split"] for r in df.collect()}


def test_published_sizes():
    assert split_sizes(412_698) == (288_888, 61_905, 61_905)
    assert split_sizes(10) == (7, 1, 2)


def test_hash_split_ignores_partitioning_and_order(spark):
    df = spark.range(3000)
    first = sides(hash_split(df, "id"))
    again = sides(hash_split(df.repartition(7).orderBy(F.desc("id")), "id"))
    assert first == again and len(first) == 3000
    counts = [sum(v == s for v in first.values()) for s in ("train", "val", "test")]
    assert sum(counts) == 3000
    assert abs(counts[0] - 2100) < 120 and abs(counts[1] - 450) < 90


def test_seed_changes_the_split(spark):
    df = spark.range(200)
    assert sides(hash_split(df, "id")) != sides(hash_split(df, "id", seed=7))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1001])
def test_exact_sizes(spark, n):
    got = sides(exact_split(spark.range(n), "id"))
    found = tuple(sum(v == s for v in got.values()) for s in ("train", "val", "test"))
    assert found == split_sizes(n)


def sizes(df):
    found = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    return tuple(found.get(s, 0) for s in ("train", "val", "test"))


@pytest.mark.parametrize("keys", [1, 3, 40])
def test_exact_sizes_where_the_key_repeats(spark, keys):
    """Keys held by many lines, told apart by another column."""
    df = spark.range(500).select((F.col("id") % keys).alias("key"), "id")
    got = exact_split(df, "key")
    assert sizes(got) == split_sizes(500) and got.columns == ["key", "id", "split"]
    assert sides(got) == sides(exact_split(df.repartition(5), "key"))
    parted = {r["key"] for r in got.groupBy("key").agg(F.count_distinct("split").alias("n")).where("n > 1").collect()}
    assert len(parted) <= 2


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_exact_sizes_of_equal_rows(spark, n):
    df = spark.range(n).select(F.lit(1).alias("id"), F.lit(None).cast("string").alias("s"))
    got = exact_split(df, "id")
    assert sizes(got) == split_sizes(n) and got.columns == ["id", "s", "split"]
