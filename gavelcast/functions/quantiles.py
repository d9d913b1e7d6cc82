"""Exact order statistics that no single task has to hold.

``median`` and ``percentile`` keep every distinct value of a group in one
buffer, which fails when one group owns a large share of a huge table. Here a
group with many rows has its value range cut into equal-width bins; the bins are
counted with map-side aggregation, and only the bin that contains a wanted rank
is looked at again. A range shrinks to the smallest and largest value really
found in its bin, so repeated values and far outliers end the search early
instead of prolonging it. Once the ranges hold few enough rows, their values are
counted and ranked. The result equals a full sort.

Several columns share each pass, told apart by a column number. The rows are never
shuffled to meet the ranges: those are broadcast, as long as there are no more than
``BROADCAST_RANGES`` of them, which is known because they are stored first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import materialize
from .columns import c

# Rows one range may hand to the final ranking.
FINAL_ROWS = 1_000_000
BINS = 1024
# Ranges, four numbers and a key each, that may be broadcast.
BROADCAST_RANGES = 200_000


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Column | None = None,
    final_rows: int = FINAL_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """Interpolated quantiles per column and group: ``(feature, [key,] prob, quantile, n)``.

    ``n`` is the number of values behind it. Missing values and rows without a group are skipped; a group without values
    of a column yields no row for it.
    """
    search = _Search(df, columns, by, final_rows, bins)
    names = F.array(*[F.lit(name) for name in columns])
    output = [F.element_at(names, F.col("id") + 1).alias("feature"), *search.keys[1:],
              "prob", "quantile", "n"]
    position = F.col("prob") * (F.col("n") - 1)
    targets = (
        search.totals.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(
            F.floor("position"), F.ceil("position")))))
    )
    low, high = F.min("value"), F.max("value")
    share = F.first(F.col("position") - F.floor("position"))
    found = search.select(targets, ["prob", "position", "n"]).groupBy(*search.keys, "prob").agg(
        (low + (high - low) * share).alias("quantile"), F.first("n").alias("n"))
    return found.select(*output)


def values_at_ranks(
    df: DataFrame,
    column: str,
    ranks: Callable[[int], Sequence[int]],
    final_rows: int = FINAL_ROWS,
    bins: int = BINS,
) -> dict[int, float]:
    """Values at zero-based ranks of a whole column, as driver scalars; ``ranks`` gets the number of values."""
    search = _Search(df, [column], None, final_rows, bins)
    ranks = ranks(search.held)
    if not search.held or not ranks:
        return {}
    wanted = F.array(*[F.lit(int(r)).cast("long") for r in sorted(set(ranks))])
    targets = search.totals.withColumn("rank", F.explode(wanted)).withColumn("wanted", F.col("rank"))
    found = search.select(targets, ["wanted"])
    return {r["wanted"]: r["value"] for r in found.collect()}


class _Search:
    """``rows``: (id, [key,] value); ``totals``: (id, [key,] n, lo, hi).

    ``held`` and ``largest``: values in all, and in the largest group of a column.
    """

    def __init__(self, df, columns, by, final_rows, bins):
        if bins < 3:
            raise ValueError("narrowing needs at least 3 bins")
        self.final_rows, self.bins = final_rows, bins
        self.keys = ["id"] if by is None else ["id", "key"]
        group = [] if by is None else ["key"]

        def number(name):
            value = c(name).cast("double")
            return F.when(~F.isnan(value), value)

        chosen = [number(name).alias(f"v{i}") for i, name in enumerate(columns)]
        wide = df.select(*chosen) if by is None else df.select(by.alias("key"), *chosen)
        if group:
            wide = wide.where(F.col("key").isNotNull())
        cells = [F.struct(F.lit(i).alias("id"), F.col(f"v{i}").alias("value"))
                 for i in range(len(columns))]
        self.rows = wide.select(*group, F.inline(F.array(*cells))).where(F.col("value").isNotNull())

        measures = [
            agg(f"v{i}").alias(f"{tag}{i}")
            for i in range(len(columns))
            for tag, agg in (("n", F.count), ("lo", F.min), ("hi", F.max))
        ]
        measured = wide.groupBy(*group).agg(*measures)
        per_column = [
            F.struct(F.lit(i).alias("id"), *[F.col(f"{tag}{i}").alias(tag) for tag in ("n", "lo", "hi")])
            for i in range(len(columns))
        ]
        totals = measured.select(*group, F.inline(F.array(*per_column))).where(F.col("n") > 0)
        self.totals = materialize(totals, "totals") if group else self._local(totals)
        size = self.totals.agg(F.sum("n").alias("held"), F.max("n").alias("largest")).first()
        self.held, self.largest = size["held"] or 0, size["largest"] or 0

    @staticmethod
    def _local(totals: DataFrame) -> DataFrame:
        """One row per column: cheaper as a literal table than as a file."""
        return totals.sparkSession.createDataFrame(totals.collect(), totals.schema)

    def select(self, targets: DataFrame, extra: Sequence[str]) -> DataFrame:
        """``(*keys, *extra, value)`` for each target's zero-based ``rank`` within its group."""
        keys = self.keys
        # "offset": rank among the rows of the range; "size": how many those are.
        targets = targets.select(*keys, *extra, "lo", "hi", F.col("rank").alias("offset"),
                                 F.col("n").alias("size"))
        largest, narrowed = self.largest, False
        while largest > self.final_rows:
            targets = materialize(self._narrow(targets), "ranges")
            open_size = F.max(F.when(F.col("lo") < F.col("hi"), F.col("size")))
            largest = targets.agg(open_size).first()[0] or 0
            narrowed = True
        return self._rank(targets, extra, narrowed)

    def _inside(self, ranges: DataFrame) -> DataFrame:
        small = self.keys == ["id"] or ranges.count() <= BROADCAST_RANGES
        matched = self.rows.join(F.broadcast(ranges) if small else ranges, self.keys, "inner")
        return matched.where(F.col("value").between(F.col("lo"), F.col("hi")))

    def _narrow(self, targets: DataFrame) -> DataFrame:
        keys, bins = self.keys, self.bins
        wide = (F.col("lo") < F.col("hi")) & (F.col("size") > self.final_rows)
        open_targets = targets.where(wide)
        ranges = open_targets.select(*keys, "lo", "hi").distinct()

        # Both ends get a bin of their own, so every pass sheds at least the extremes,
        # infinities included. Halving first keeps the width of the widest ranges finite.
        share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bin_no = (
            F.when(F.col("value") == F.col("lo"), 0)
            .when(F.col("value") == F.col("hi"), bins - 1)
            .otherwise(1 + F.least(F.floor(share * (bins - 2)), F.lit(bins - 3)))
        )
        counted = (
            self._inside(ranges)
            .groupBy(*keys, "lo", "hi", bin_no.alias("bin"))
            .agg(F.count("value").alias("copies"), F.min("value").alias("bin_lo"),
                 F.max("value").alias("bin_hi"))
        )
        hit = self._located(open_targets, counted, [*keys, "lo", "hi"], "bin")
        kept = [name for name in targets.columns if name not in ("lo", "hi", "offset", "size")]
        narrowed = hit.select(
            *kept, F.col("bin_lo").alias("lo"), F.col("bin_hi").alias("hi"),
            (F.col("offset") - F.col("before")).alias("offset"), F.col("copies").alias("size"))
        return targets.where(~wide).select(*narrowed.columns).unionByName(narrowed)

    def _rank(self, targets, extra, narrowed) -> DataFrame:
        keys = self.keys
        if not narrowed:
            counted = self.rows.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("copies"))
            found = self._located(targets.drop("lo", "hi"), counted, keys, "value")
            return found.select(*keys, *extra, "value")
        single = F.col("lo") == F.col("hi")
        done = targets.where(single).select(*keys, *extra, F.col("lo").alias("value"))
        rest = targets.where(~single)
        counted = (
            self._inside(rest.select(*keys, "lo", "hi").distinct())
            .groupBy(*keys, "lo", "hi", "value").agg(F.count(F.lit(1)).alias("copies"))
        )
        found = self._located(rest, counted, [*keys, "lo", "hi"], "value")
        return done.unionByName(found.select(*keys, *extra, "value"))

    @staticmethod
    def _located(targets, counted, keys, order) -> DataFrame:
        """Pair each target with the counted entry its offset falls into.

        The window runs over at most ``bins`` or ``final_rows`` entries per key.
        """
        upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("before", F.coalesce(F.sum("copies").over(upto), F.lit(0)))
        inside = (F.col("offset") >= F.col("before")) & (
            F.col("offset") < F.col("before") + F.col("copies"))
        return targets.join(counted, list(keys)).where(inside)
