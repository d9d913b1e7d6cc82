"""Connected components and a bounded filter on ids, as joins over stored tables."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import materialize

#: Bits of the filter: 8 MB, whatever the size of the table.
FILTER_BITS = 1 << 26


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every end of an edge ``(a, b)``: the smallest node it is linked with, itself included.

    Each round takes the smallest label among neighbours and then that label's own label, so labels travel twice as far in
    every round. Neighbours are aggregated before they are shuffled, so a node of very many edges is no hot task.
    """
    both = materialize(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        root = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = materialize(hooked.join(root, "label").select(
            "node", "old", F.least("label", "root").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels


def slot(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(FILTER_BITS - 1)


def low_bits(number: Column) -> Column:
    """The slot of a number that is a hash already."""
    return number.bitwiseAND(FILTER_BITS - 1)


def id_filter(ids: DataFrame, key: str) -> np.ndarray:
    """The filter that every one of ``ids`` passes."""
    return bit_filter(ids.select(slot(F.col(key)).alias("slot")))


def bit_filter(slots: DataFrame) -> np.ndarray:
    """A bit per slot that occurs, as 64-bit words: nothing is missed, a few others pass.

    The bits are set by an aggregation; the driver holds ``FILTER_BITS / 8`` bytes at any number of rows.
    """
    words = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def passes(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) != 0


def lists(arrays: Iterable[np.ndarray], dtype) -> pa.ListArray:
    """An Arrow list column of numpy arrays."""
    arrays = list(arrays)
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    flat = np.concatenate(arrays).view(dtype) if arrays else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
