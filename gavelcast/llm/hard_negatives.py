"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose score lies in a window.

A score is the integer inner product of two vectors whose components are scaled and rounded down. The window of a
positive of score ``p`` reaches from ``low`` to ``high`` percent of ``p``. The windows of one anchor overlap, so they are
not searched one by one. Their upper limits, in falling order, cut the scores into disjoint slots; every task keeps the
best ``n_negatives`` rows of each slot, partial lists are combined per slot, and merging the slots from the lowest
upwards leaves at each slot the best rows of all scores up to its limit. That list, cut at the lower bound of the
window, is the answer, since it is in falling order.

All rows are scored with all anchors: anchors in blocks of at most ``BLOCK_BYTES`` of vectors, one scan for positives and
one for negatives per block. A block and its limits are all that is broadcast. A task scans at least ``ROWS_A_TASK``
rows, so that its lists are few against what it has read, and a kept row leaves it only if it beat all earlier ones.

Defined cases. A row without id, label or vector, or with a null or non-finite component (also once scaled), takes no
part. Vectors of different lengths: the shorter one counts as filled up with zeros; an empty one scores 0. Long vectors
are scored in smaller pieces of a batch. Scores are exact; beyond 2^62 they count as 2^62. Ties go by smaller id. Rows
that repeat an id are separate rows as candidates; as anchors the first of them (by label, then vector) stands for all,
and none of them is its positive. An anchor without positives, or a positive without negatives, has no result row. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import c
from ..runtime import materialize, scratch_path

#: Bytes of anchor vectors (as doubles) that are broadcast at once.
BLOCK_BYTES = 1 << 24
#: A scan has no more tasks than cores while each would read fewer rows than this.
ROWS_A_TASK = 1 << 16
#: Scores held at once by a task.
SCORES = 1 << 21
#: Numbers of one piece of a batch.
NUMBERS = 1 << 22
#: Below this, sums of products of doubles that are whole numbers are exact.
EXACT = float(1 << 53)
MOST = 1 << 62
FOUND = "anchor long, slot int, score long, id long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


@dataclass
class Block:
    """Some anchors: ids, labels, whole-number vectors and, for the second scan, limits and lower bounds."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray | None = None
    least: np.ndarray | None = None


class Best:
    """The best ``size`` entries of each key: highest score, then smallest id."""

    def __init__(self, keys: int, size: int):
        self.size = size
        self.key = self.score = self.id = np.zeros(0, np.int64)
        self.bar = np.full(keys, -MOST - 1, np.int64)
        self.bar_id = np.full(keys, np.iinfo(np.int64).max, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = (score > self.bar[key]) | ((score == self.bar[key]) & (ids < self.bar_id[key]))
        if not better.any():
            return
        key, score, ids = (np.concatenate([old, new[better]]) for old, new in (
            (self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        kept = rank < self.size
        full = rank == self.size - 1
        self.bar[key[full]], self.bar_id[key[full]] = score[full], ids[full]
        self.key, self.score, self.id = key[kept], score[kept], ids[kept]


def whole(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """Rows of scaled components rounded down, ``width`` of them, filled up with zeros."""
    lengths = np.asarray(vectors.value_lengths()).astype(np.int64)
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, anchors down and rows across."""
    out = anchors @ rows.T
    if not out.size:
        return out
    reach = max(anchors.shape[1], 1) * np.abs(rows).max(axis=1, initial=0) * np.abs(anchors).max(initial=0)
    unsafe = np.flatnonzero(reach >= EXACT)
    if len(unsafe):
        out = np.clip(out, -MOST, MOST).astype(np.int64)
        integers = np.frompyfunc(int, 1, 1)
        exact = integers(anchors).astype(object) @ integers(rows[unsafe]).astype(object).T
        out[:, unsafe] = np.clip(exact, -MOST, MOST).astype(np.int64)
    return out


def pieces(batches: Iterator[pa.RecordBatch], block: Block, scale: int):
    """``(ids, label codes, vectors)`` in order of id; the code of a label no anchor has is -1."""
    width = block.vectors.shape[1]
    known = pd.Index(pd.unique(block.labels))
    for batch in batches:
        step = max(1, NUMBERS // max(width, 1))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            codes = known.get_indexer(part.column(1).to_pandas())
            yield ids[order], codes[order], whole(part.column(2), scale, width)[order]


def _emit(block: Block, best: Best, slots: int) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays(
        [pa.array(block.ids[best.key // slots]), pa.array((best.key % slots).astype(np.int32)),
         pa.array(best.score), pa.array(best.id)], ["anchor", "slot", "score", "id"])


def nearest_positives(batches, block: Block, size: int, scale: int):
    """The best rows of each anchor's own label, as far as this task sees them."""
    best = Best(len(block.ids), size)
    known = pd.Index(pd.unique(block.labels))
    groups = [np.flatnonzero(known.get_indexer(block.labels) == code) for code in range(len(known))]
    for ids, codes, rows in pieces(batches, block, scale):
        for code in np.unique(codes[codes >= 0]):
            mine, own = np.flatnonzero(codes == code), groups[code]
            step = max(1, SCORES // len(mine))
            for some in (own[i:i + step] for i in range(0, len(own), step)):
                scores = products(block.vectors[some], rows[mine])
                other = block.ids[some][:, None] != ids[mine][None, :]
                floor = best.bar[some]
                if len(mine) > 2 * size and (floor < -MOST).any():  # nothing to beat yet: each anchor's own best of these rows
                    own_best = np.where(other, scores, -MOST - 1)
                    own_best.partition(len(mine) - size, axis=1)
                    floor = np.maximum(floor, own_best[:, len(mine) - size].astype(np.int64))
                a, r = np.nonzero((scores >= floor[:, None]) & other)
                best.add(some[a], scores[a, r].astype(np.int64), ids[mine][r])
    yield from _emit(block, best, 1)


def best_by_slot(batches, block: Block, size: int, scale: int):
    """The best rows of other labels in each slot, as far as this task sees them."""
    slots = block.limits.shape[1]
    best = Best(len(block.ids) * slots, size)
    own = pd.Index(pd.unique(block.labels)).get_indexer(block.labels)
    last = (block.limits > -MOST - 1).sum(axis=1) - 1
    for ids, codes, rows in pieces(batches, block, scale):
        step = max(1, SCORES // max(len(ids), 1))
        for some in (np.arange(i, min(i + step, len(own))) for i in range(0, len(own), step)):
            scores = products(block.vectors[some], rows)
            floor = np.maximum(block.least[some], best.bar[some * slots + last[some]])
            a, r = np.nonzero((scores >= floor[:, None]) & (scores <= block.limits[some, :1])
                              & (own[some][:, None] != codes[None, :]))
            found = scores[a, r].astype(np.int64)
            slot = (block.limits[some[a]] >= found[:, None]).sum(axis=1) - 1
            best.add(some[a] * slots + slot, found, ids[r])
    yield from _emit(block, best, slots)


def _percent(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a score in whole numbers, rounded up or down, without products beyond a long."""
    rest = F.pmod(score, F.lit(100))
    hundreds = F.call_function("div", score - rest, F.lit(100))
    return percent * hundreds + F.call_function("div", percent * rest + (99 if up else 0), F.lit(100))


def usable(rows: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """``(id, label, vector)`` of the rows that take part."""
    finite = F.forall(c(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf")))
    return rows.select(c(key).cast("long").alias("id"), c(label).alias("label"), c(vector).alias("vector")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))


def top(found: DataFrame, size: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the columns ``id``, ``label`` and ``vector``. Positives are the ``n_positives``
    best rows of the anchor's label. Each pair is followed by at most ``n_negatives`` rows of other labels with
    ``low * positive <= 100 * negative <= high * positive`` (scores), best first.
    """
    spark = rows.sparkSession
    stored = materialize(usable(rows, key, label, vector, scale), "vectors")
    chosen = stored.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first"))
    anchors = materialize(chosen.select("id", "first.label", "first.vector"), "anchors")
    size = anchors.agg(F.count("id").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not size["n"]:
        return spark.createDataFrame([], RESULT)
    width = max(size["width"], 1)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(stored.count() / ROWS_A_TASK))
    scan = stored.coalesce(tasks) if stored.rdd.getNumPartitions() > tasks else stored
    blocks = math.ceil(size["n"] * width * 8 / BLOCK_BYTES)
    part = F.pmod(F.xxhash64("id"), F.lit(blocks))
    path = scratch_path(spark, "negatives")
    for number in range(blocks):
        found = _block(scan, anchors.where(part == number), width, n_positives, n_negatives, low, high, scale)
        found.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def _block(scan, anchors, width, n_positives, n_negatives, low, high, scale) -> DataFrame:
    """The result rows of the anchors of one block."""
    spark = scan.sparkSession
    table = anchors.toArrow().sort_by("id").combine_chunks()
    vectors = table.column("vector").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))
    block = Block(table.column("id").to_numpy(), table.column("label").to_pandas().to_numpy(), whole(vectors, scale, width))
    sent = spark.sparkContext.broadcast(block)
    found = scan.mapInArrow(lambda batches: nearest_positives(batches, sent.value, n_positives, scale), FOUND)
    upper, lower = _percent(F.col("score"), high, False), _percent(F.col("score"), low, True)
    near = top(found, n_positives, "anchor").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "place", "id", "score", upper.alias("upper"), lower.alias("lower")))).alias("positives"))
    limits = F.sort_array(F.array_distinct("positives.upper"), asc=False)
    positives = materialize(near.select("anchor", "positives", limits.alias("limits"), F.array_min("positives.lower").alias("least")), "positives")

    # The limits of one block: at most n_positives numbers an anchor.
    known = positives.select("anchor", "limits", "least").toArrow()
    at = np.searchsorted(block.ids, known.column("anchor").to_numpy())
    block.limits = np.full((len(block.ids), n_positives), -MOST - 1, np.int64)
    block.least = np.full(len(block.ids), MOST + 1, np.int64)
    block.least[at] = known.column("least").to_numpy()
    for row, values in zip(at, known.column("limits").to_pylist()):
        block.limits[row, :len(values)] = values
    searched = block.least <= block.limits[:, 0]
    ready = Block(*(x[searched] for x in (block.ids, block.labels, block.vectors, block.limits, block.least)))
    again = spark.sparkContext.broadcast(ready)
    found = scan.mapInArrow(lambda batches: best_by_slot(batches, again.value, n_negatives, scale), FOUND)
    return answers(top(found, n_negatives, "anchor", "slot"), positives, n_negatives)


def answers(slots: DataFrame, positives: DataFrame, size: int) -> DataFrame:
    """Result rows from the best rows per slot and the positives with their limits.

    A slot's rows all score above those of later slots, so a suffix is the slot's rows followed by the suffix after
    it, cut to ``size``. At most ``size`` rows a slot and ``n_positives`` slots meet in a row.
    """
    kind = "array<array<struct<slot:int,place:int,score:bigint,id:bigint>>>"
    entries = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "score", "id"))).alias("entries"))
    joined = positives.join(entries, "anchor")
    of_slot = F.transform("limits", lambda _, i: F.filter("entries", lambda e: e["slot"] == i))
    suffixes = F.aggregate(
        F.reverse(of_slot), F.array().cast(kind),
        lambda done, own: F.concat(F.array(F.slice(F.concat(own, F.coalesce(F.get(done, F.lit(0)), F.array().cast(kind[6:-1]))), 1, size)), done))
    each = joined.select("anchor", "limits", suffixes.alias("suffixes"), F.explode("positives").alias("p"))
    own = F.get("suffixes", (F.array_position("limits", F.col("p.upper")) - 1).cast("int"))
    window = each.select("anchor", "p", F.posexplode(F.filter(own, lambda e: e["score"] >= F.col("p.lower"))).alias("at", "e"))
    return window.select(
        F.col("anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), (F.col("at") + 1).alias("rank"),
        F.col("e.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("e.score").alias("negative_score"))
