"""Quality score of a text: regularised quadratic discriminant analysis of document statistics.

Each text is described by logarithms and log-odds of counts (``FEATURES``). Per label, the mean and
covariance of the labelled training rows come from one aggregation of sums and products over Spark; nothing but
those sums reaches the driver. Covariances are shrunk towards a diagonal of the pooled variances. The score of a text is the
logistic function of the difference of log densities and log priors, from Mahalanobis distances with
the Cholesky factor of each class, which is computed once.

Rows whose ``crc32(id as text) mod 5`` is 0 are held out of training. Only the text enters a score.

Defined cases: a null or empty text has the statistics of an empty one and gets a score; a null id is held out; null
labels are skipped, and a row that has both labels counts for both. With training rows of one label only, or
of none, every score is 1, 0 or 0.5. Rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import c
from ..runtime import materialize
from .tokens import buffers, word_hashes

FEATURES = ("words", "word_length", "upper", "digit", "symbol", "stop", "exclaim", "beyond_ascii",
            "new_words", "same_as_before", "long_lines")
SHRINKAGE, RIDGE = 0.1, 1e-3
FOLDS, THRESHOLD = 5, 0.3


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER, DIGIT = _mask(bytes(range(65, 91))), _mask(bytes(range(48, 58)))
SYMBOL, STOP, EXCLAIM = _mask(b"#*$%&|<>=@^~{}[]\\_+"), _mask(b".,;:'\"()-"), _mask(b"!?")
BEYOND, FEED = _mask(bytes(range(128, 256))), _mask(b"\n")


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log-odds of a share, with half a count on either side so that 0 of 0 is 0."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text."""
    data, offsets = buffers(texts)
    size = np.diff(offsets)

    def count(mask):
        sums = np.zeros(len(size), np.int64)
        filled = np.flatnonzero(size)
        if len(filled):
            sums[filled] = np.add.reduceat(mask[data], offsets[:-1][filled], dtype=np.int64)
        return sums

    hashes, first = word_hashes(texts)
    words = np.diff(first)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1].tolist(), first[1:].tolist())], np.int64)
    same = np.zeros(len(hashes) + 1, np.int64)
    same[2:] = np.cumsum(hashes[1:] == hashes[:-1]) if len(hashes) else 0
    # A word's neighbour before it belongs to the same text unless the word is the text's first.
    last, begin = first[1:], np.minimum(first[:-1] + 1, first[1:])
    repeated = same[last] - same[begin]
    lines = count(FEED) + 1
    return np.stack([
        np.log1p(words), np.log((size + 1) / (words + 1)), _odds(count(UPPER), size), _odds(count(DIGIT), size),
        _odds(count(SYMBOL), size), _odds(count(STOP), size), _odds(count(EXCLAIM), size), _odds(count(BEYOND), size),
        _odds(distinct, words), _odds(repeated, words), np.log((size + 1) / lines)], axis=1)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, features)`` per row."""
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column(1))
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=["id", "features"])

    return docs.select(c(key).alias("id"), c(text)).mapInArrow(run, schema)


def fit(rows: DataFrame, labels: DataFrame, key: str, label: str, shrinkage: float = SHRINKAGE) -> list[tuple]:
    """``(label, log prior, mean, inverse Cholesky factor, log determinant)`` per label with training rows."""
    d = len(FEATURES)
    known = labels.select(c(key).alias("id"), c(label).cast("int").alias("label")).where("id is not null and label in (0, 1)").distinct()
    train = rows.where(~held_out(F.col("id"))).join(known, "id")
    x = [F.get("features", F.lit(i)) for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = sorted(train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect(), key=lambda r: r["label"])
    total = sum(r["n"] for r in found)
    moments, pooled = [], np.zeros(d)
    for r in found:
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i + 1):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        covariance = second - np.outer(mean, mean)
        pooled += covariance.diagonal() * r["n"] / total
        moments.append((r, mean, covariance))
    classes = []
    for r, mean, covariance in moments:
        shrunk = (1 - shrinkage) * covariance + np.diag(shrinkage * pooled + RIDGE)
        lower = np.linalg.cholesky(shrunk)
        classes.append((r["label"], float(np.log(r["n"] / total)), mean, np.linalg.inv(lower),
                        float(2 * np.log(lower.diagonal()).sum())))
    return classes


def score(features: np.ndarray, classes: list[tuple]) -> np.ndarray:
    if len(classes) < 2:
        return np.full(len(features), float(classes[0][0]) if classes else 0.5)
    density = []
    for _, prior, mean, inverse, log_det in classes:
        away = (features - mean) @ inverse.T
        density.append(prior - 0.5 * (away ** 2).sum(axis=1) - 0.5 * log_det)
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           threshold: float = THRESHOLD) -> DataFrame:
    """``(key, held_out, score, predicted)`` per row of ``docs``. The statistics are written once; the texts are read once."""
    rows = materialize(described(docs, key, text), "statistics")
    classes = fit(rows, labels, key, label)
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(x, classes))], names=["id", "score"])

    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(key), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
