import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gavelcast.llm import quality_model as q

from . import plain


def test_statistics_equal_plain_ones():
    texts = [None, "", "A b b B1!?", "x\ny z,", "é #|", "w " * 2000]
    got = q.statistics(pa.array(texts))

    def odds(part, whole):
        return np.log((part + 0.5) / (whole - part + 0.5))

    for text, row in zip(texts, got):
        text = text or ""
        raw, own = text.encode(), plain.words(text)

        def share(chars):
            return odds(sum(b in chars for b in raw), len(raw))

        want = [np.log1p(len(own)), np.log((len(raw) + 1) / (len(own) + 1)), share(range(65, 91)), share(range(48, 58)),
                share(b"#*$%&|<>=@^~{}[]\\_+"), share(b".,;:'\"()-"), share(b"!?"), share(range(128, 256)), odds(len(set(own)), len(own)),
                odds(sum(a == b for a, b in zip(own, own[1:])), len(own)), np.log((len(raw) + 1) / (raw.count(b"\n") + 1))]
        assert np.allclose(row, want)


def test_scores_equal_the_densities(spark):
    rng = np.random.default_rng(0)
    d = len(q.FEATURES)
    rows, labels = [], []
    for i in range(600):
        label = i % 3 > 0
        x = rng.normal(label * 1.0, 1 + label, d)
        rows.append((i, x.tolist()))
        labels.append((i, int(label)))
    table = spark.createDataFrame(rows, "id long, features array<double>")
    known = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")
    classes = q.fit(table, known, "doc_id", "quality")
    train = [(np.array(x), y) for (i, x), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5]
    pooled = sum(np.var([x for x, y in train if y == k], axis=0) * sum(y == k for _, y in train) for k in (0, 1)) / len(train)
    logs = []
    x = np.array([r[1] for r in rows])
    for k in (0, 1):
        own = np.array([a for a, y in train if y == k])
        cov = (1 - q.SHRINKAGE) * np.cov(own.T, bias=True) + np.diag(q.SHRINKAGE * pooled + q.RIDGE)
        away = x - own.mean(axis=0)
        logs.append(np.log(len(own) / len(train)) - 0.5 * (away @ np.linalg.inv(cov) * away).sum(axis=1) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(q.score(x, classes), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = q.scored(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.97
    good, bad = got[got.quality == 1]["score"].to_numpy(), got[got.quality == 0]["score"].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, q.scored(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, ""), (3, "y " * 30000)], "doc_id long, text string").withColumn("id", F.lit(0))
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = q.scored(docs, none).collect()
    assert len(rows) == 5 and all(r["score"] == 0.5 and r["predicted"] == 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    one = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, quality int")
    assert all(r["score"] == 0.0 for r in q.scored(docs, one).collect())
    assert q.scored(docs.where("false"), one).count() == 0
