"""Left lookup of fitted values: the one join of the library.

Small tables are broadcast. A table whose measured size is above the limit is
joined by shuffle, with its most frequent keys split off first: those are few by
construction (a key must hold at least 1/HOT_SHARE of the rows seen at fit), so
they are broadcast and the rows they resolve, like rows without a key, are spread
over all partitions instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c, level_text

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 1000
SPREAD = 1024


@dataclass
class LookupTable:
    """A ``(key, *values, n)`` table with the measurements that decide the join."""

    table: DataFrame
    size_bytes: int
    rows_seen: int
    broadcast_limit: int = BROADCAST_BYTES

    @property
    def small(self) -> bool:
        return self.size_bytes <= self.broadcast_limit


def attach(df: DataFrame, key: str, lookup: LookupTable, values: Sequence[str]) -> DataFrame:
    """Add ``values`` of the row's key; missing where the key is null or unknown."""
    wanted = level_text(df, key)
    table = lookup.table.select(F.col("key").alias("__key"), *values, F.col("n").alias("__n"))
    if lookup.small:
        small = F.broadcast(table.drop("__n"))
        return df.join(small, wanted == F.col("__key"), "left").drop("__key")

    is_hot = F.col("__n") * HOT_SHARE >= F.lit(lookup.rows_seen)
    hot = table.where(is_hot).select(
        F.col("__key").alias("__hot"), *[F.col(v).alias(f"__hot_{v}") for v in values])
    cold = table.where(~is_hot).drop("__n").withColumn("__lane", F.lit(0))

    with_hot = df.join(F.broadcast(hot), wanted == F.col("__hot"), "left")
    open_key = F.when(F.col("__hot").isNull(), wanted)
    lane = F.pmod(F.xxhash64(*[c(n) for n in df.columns]), F.lit(SPREAD)).cast("int")
    with_hot = with_hot.withColumn("__open", open_key).withColumn(
        "__row_lane", F.when(F.col("__open").isNull(), lane).otherwise(0))
    same = (F.col("__open") == F.col("__key")) & (F.col("__row_lane") == F.col("__lane"))
    joined = with_hot.join(cold, same, "left")
    filled = [F.coalesce(F.col(f"__hot_{v}"), F.col(v)).alias(v) for v in values]
    return joined.select(*[c(n) for n in df.columns], *filled)
