import math

from pyspark.sql import functions as F

from gavelcast.llm import quality_rules as q

from . import plain

TEXTS = [None, "", " \n\t ", "a", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 30000, "l1\nl1\n\nl2\nl1 \n", "# $ %& a|b <c>*\x0b\x0c\r",
         "é ß 日本 \u00a0x", "a b c d e f g h i j k a b c d e f g h z a b c d e f g h", "LA!! SE!! " * 40, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"]


def test_base_counts_equal_plain_ones(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    for r in q.measure(docs).collect():
        want = plain.base_counts(TEXTS[r["doc_id"]])
        assert tuple(r[name] for name in q.BASE) == want, TEXTS[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert sum(r["class_counts"]) == len(TEXTS[r["doc_id"]] or "") and sum(r["common_counts"]) == want[0]


def test_base_counts_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in q.measure(docs).collect():
        assert tuple(r[name] for name in q.BASE) == plain.base_counts(text[r["doc_id"]])


def test_class_counts(spark):
    docs = spark.createDataFrame([(1, "abC9 .,#é~\x00\u00a0"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_counts"] for r in q.measure(docs).collect()}
    assert got == {1: [2, 1, 2, 1, 1, 2, 1, 2], 2: [0] * 8}


def test_distance_equals_the_definition(spark):
    rows = spark.createDataFrame([([3, 0, 5, 2],), ([0, 0, 0, 1],)], "counts array<long>")
    shares = [0.25, 0.25, 0.5, 0.0]
    for r in rows.select("counts", q.distance(F.col("counts"), shares).alias("d")).collect():
        p = [x / sum(r["counts"]) for x in r["counts"]]
        m = [(a + b) / 2 for a, b in zip(p, shares)]
        want = math.sqrt(sum(sum(a * math.log2(a / b) for a, b in zip(side, m) if a) for side in (p, shares)) / 2)
        assert math.isclose(r["d"], want, abs_tol=1e-12)


def test_verdicts_agree_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = q.quality(docs, carry=["doc_id"]).join(labels, "doc_id").where("not base_failed")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.99 and share[0] < 0.3


def test_edges_and_clashing_names(spark):
    rows = [(1, None, None), (1, "a " * 10, "xx"), (2, "the of and to in a " * 4 + "different words follow here " * 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"kept": F.lit("mine"), "n_words": F.lit(-1)})
    assert q.quality(docs).count() == 3
    kept = q.clean(docs)
    assert kept.columns == docs.columns and all(r["kept"] == "mine" and r["n_words"] == -1 for r in kept.collect())
    assert q.clean(docs.where("false")).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    q.measure(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_distance_sums_the_counts_once(spark, capsys):
    """No term of the distance sums the histogram again, and a histogram without counts has no distance."""
    rows = spark.createDataFrame([([3, 0, 5],), ([0, 0, 0],)], "counts array<long>")
    found = rows.select(q.distance(F.col("counts"), [0.25, 0.25, 0.5]).alias("d"))
    found.explain()
    plan = capsys.readouterr().out.replace("cast(", "")
    assert "/ aggregate(" not in plan and "aggregate(counts" in plan
    got = [r["d"] for r in found.collect()]
    assert got[0] > 0 and got[1] is None
