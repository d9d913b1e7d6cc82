import math
import random

import pytest
from pyspark.sql import functions as F

from gavelcast.llm import hard_negatives
from gavelcast.llm.hard_negatives import MOST, mine


def plain(rows, every, low=80, high=100, size=5, scale=256):
    """Result rows of ``(id, vector, label)`` rows, by definition."""
    used = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in rows
            if i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, l in sorted(used, key=lambda r: (r[0], r[2], r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, l))
    out = []
    for a, (vector, label) in anchors.items():
        scored = sorted((-max(-MOST, min(MOST, sum(x * y for x, y in zip(vector, v)))), i, l) for i, v, l in used if i != a)
        for p, positive, _ in [r for r in scored if r[2] == label][:size]:
            found = [(n, i) for n, i, l in scored if l != label and low * -p <= 100 * -n <= high * -p][:size]
            out += [(a, positive, k + 1, i, -p, -n) for k, (n, i) in enumerate(found)]
    return sorted(out)


def found(spark, rows, every, **options):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return sorted(map(tuple, mine(docs.repartition(3), F.col("id") % every == 0, **options).collect()))


def random_rows(n, width, labels, seed, steps=8):
    rng = random.Random(seed)
    return [(i, [rng.randint(-steps, 2 * steps) / steps for _ in range(width)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_definition(spark, seed):
    rows = random_rows(400, 3 + seed, 2 + seed, seed, steps=4)
    got = found(spark, rows, 10)
    assert got and got == plain(rows, 10)
    assert found(spark, rows, 25, low=50, high=120, n_positives=3, n_negatives=3) == plain(rows, 25, 50, 120, 3)


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(300)] + [(1000 + i, [0.9, 0.5], i % 3) for i in range(100)]
    assert found(spark, rows, 50) == plain(rows, 50)


def test_defined_cases(spark):
    rows = random_rows(80, 4, 2, 9) + [
        (None, [1.0] * 4, 1), (100, None, 1), (110, [1.0] * 4, None), (120, [1.0, None, 1.0, 1.0], 0), (130, [math.nan] * 4, 0),
        (140, [math.inf] * 4, 1), (150, [], 1), (160, [1.0], 0), (170, [1.0] * 9, 0), (10, [2.0] * 4, 0), (10, [2.0] * 4, 0)]
    assert found(spark, rows, 10) == plain(rows, 10)
    assert found(spark, rows[:0], 10) == [] and found(spark, rows[81:82], 10) == []
    assert found(spark, [(0, [], 1), (1, [], 1), (2, [], 2)], 2) == plain([(0, [], 1), (1, [], 1), (2, [], 2)], 2)


def test_large_scores_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1, 3e5, 2.5e7, 1e9 if i % 9 == 0 else 1.5]) * rng.random() for _ in range(5)], i % 3) for i in range(90)]
    assert found(spark, rows, 10) == plain(rows, 10)


def test_blocks_and_pieces_do_not_change_results(spark, monkeypatch):
    rows = random_rows(500, 4, 3, 3, steps=3)
    want = found(spark, rows, 5)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 1000)
    assert found(spark, rows, 5) == want == plain(rows, 5)


def test_clashing_columns(spark):
    rows = random_rows(60, 3, 2, 1)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {n: F.lit("x") for n in ("id", "vector", "score", "anchor", "slot", "place")})
    assert sorted(map(tuple, mine(docs, F.col("id") % 10 == 0).collect())) == plain(rows, 10)
