from pyspark.sql import functions as F

from gavelcast.llm import ngram_join
from gavelcast.llm.links import components

from . import plain

BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, ""), (2, None), (3, " \n"), (4, "a b"), (9, "A  b"), (5, "a b c"), (None, "a b c"), (6, BASE), (6, BASE), (7, BASE + " x"),
        (8, BASE.upper()), (10, BASE.replace("w30", "y")), (11, BASE.replace("w30", "z").replace("w10", "q")), (12, "x " * 9000), (13, "x x x x x")]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def found(docs, **options):
    return sorted(map(tuple, ngram_join.groups(docs, **options).collect()), key=key)


def test_equals_all_pairs_on_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80), (1, 50), (2, 100)):
        assert found(docs, width=width, percent=percent) == sorted(plain.groups(ROWS, width, percent), key=key)


def test_equals_all_pairs_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = found(docs)
    assert got == sorted(plain.groups(rows, 4, 85), key=key)
    assert any(a != b for a, _, b in got)


def test_a_chain_of_edits_and_a_shared_passage(spark):
    chain, words = [], [f"c{i}" for i in range(80)]
    for i in range(40):
        words = [*words[:2 * i % 78], f"e{i}", *words[2 * i % 78 + 1:]]
        chain.append((100 + i, " ".join(words)))
    shared = [(500 + i, " ".join(f"p{k}" for k in range(30)) + " " + " ".join(f"u{i}_{k}" for k in range(40))) for i in range(60)]
    rows = chain + shared
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(plain.groups(rows, 4, 85), key=key)


def test_copies_with_few_edits_each(spark, monkeypatch):
    """Most pairs of such copies are not linked, though all are close to one text."""
    monkeypatch.setattr(ngram_join, "SIGHTINGS", 2)
    words = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(240):
        own = list(words)
        for e in range(i % 6):
            own[(i * 37 + e * 53) % 120] = f"e{i // 3}_{e}"
        rows.append((i, " ".join(own)))
    got = found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert got == sorted(plain.groups(rows, 4, 85), key=key)
    assert 20 < len({x[2] for x in got}) < 200


def test_frequent_shingles_do_not_change_results(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SIGHTINGS", 2)
    monkeypatch.setattr(ngram_join, "AT_ONCE", 500)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert found(docs, width=5, percent=80) == sorted(plain.groups(rows, 5, 80), key=key)


def test_one_of_each_keeps_the_smallest_id_and_the_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"id": F.lit("x"), "node": F.lit(1), "n": F.lit(None).cast("int")})
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = plain.groups(ROWS, 5, 80)
    assert sorted(x for x in ids if x is not None) == sorted({a for a, _, b in want if a is not None and a == b})
    assert ngram_join.one_of_each(docs, broadcast_ids=0).count() == kept.count()


def test_one_of_each_decides_per_text_where_ids_repeat(spark):
    other, third = (" ".join(f"{x}{i}" for i in range(60)) for x in "uv")
    rows = [(1, BASE, "a"), (1, other, "b"), (1, other, "b"), (1, None, "c"), (2, BASE + " x", "d"), (2, third, "e"), (3, other + " x", "f"),
            (4, third.upper(), "g"), (5, "", "h"), (5, None, "i"), (6, BASE + " y", "j"), (6, "", "k"), (7, "q " * 9, "l"), (7, "q " * 10, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    # Near copies of 1 and 2 go; 1 keeps its texts, one of two copies, and 2 the text that is new.
    for most in (1_000_000, 0):
        kept = ngram_join.one_of_each(docs, broadcast_ids=most).collect()
        assert sorted(r["note"] for r in kept) == list("abcehikl")


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.groups(docs).count() == 0 and ngram_join.one_of_each(docs).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(90, 80)], "a long, b long")
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(51)} | {(80, 80), (90, 80)}
