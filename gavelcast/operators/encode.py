"""Target encoding and one-hot encoding, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c, level_text
from ..params import FILL_TEXT, RARE_BELOW, RARE_TEXT
from ..runtime import materialize
from .lookup import BROADCAST_BYTES, LookupTable, attach

# One plan column is built per kept level, so their number must fit a plan. More levels go to ``sparse``.
COLUMN_LEVELS = 2_000
# Stands for "no feature" in the table of target means.
ALL_ROWS = "(all rows)"


def _levels(
    df: DataFrame, features: Sequence[str], *extra: Column, overall: bool = False
) -> DataFrame:
    """``(feature, level, *extra)``: one row per cell, in one pass for all features."""
    named = [(f, level_text(df, f)) for f in features]
    if overall:
        named.append((ALL_ROWS, F.lit(ALL_ROWS)))
    cells = [F.struct(F.lit(f).alias("feature"), level.alias("level")) for f, level in named]
    return df.select(*extra, F.inline(F.array(*cells)))


# ---- target encoding -----------------------------------------------------------


@dataclass
class TargetEncoding:
    """Mean target per level. ``when_null`` is the mean of rows whose text is the fill word."""

    lookups: dict[str, LookupTable]
    when_null: dict[str, float | None]
    overall: float | None
    state: DataFrame


def target_means(
    df: DataFrame, features: Sequence[str], target: str, with_overall: bool = False
) -> DataFrame:
    """``(feature, level, mean, n)``: one shuffle of partial sums for all features.

    ``with_overall`` adds the mean of all rows as a feature of its own.
    """
    y = c(target).cast("double").alias("y")
    cells = _levels(df, features, y, overall=with_overall)
    return (
        cells.where(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n"))
    )


def fit_target(
    df: DataFrame, features: Sequence[str], target: str,
    broadcast_limit: int = BROADCAST_BYTES,
) -> TargetEncoding:
    features = [f for f in features if f in df.columns]
    means = target_means(df, features, target, with_overall=True)
    return target_encoding(materialize(means, "target-means", "feature"), features, broadcast_limit)


def target_encoding(
    state: DataFrame, features: Sequence[str], broadcast_limit: int = BROADCAST_BYTES
) -> TargetEncoding:
    """Wrap a stored ``(feature, level, mean, n)`` table, measuring each feature's share."""
    sizes = {
        r["feature"]: r
        for r in state.groupBy("feature").agg(
            F.sum(F.octet_length("level") + 48).alias("bytes"),
            F.sum("n").alias("rows"),
            F.max(F.when(F.col("level") == FILL_TEXT, F.col("mean"))).alias("fill_mean"),
            F.max(F.when(F.col("level") == ALL_ROWS, F.col("mean"))).alias("overall"),
        ).collect()
    }
    lookups, when_null = {}, {}
    for f in features:
        table = state.where(F.col("feature") == f).select(
            F.col("level").alias("key"), F.col("mean").alias("__mean"), "n")
        size = sizes.get(f)
        lookups[f] = LookupTable(
            table, size["bytes"] if size else 0, size["rows"] if size else 0, broadcast_limit)
        when_null[f] = size["fill_mean"] if size else None
    overall = sizes[ALL_ROWS]["overall"] if ALL_ROWS in sizes else None
    return TargetEncoding(lookups, when_null, overall, state)


def apply_target(df: DataFrame, encoding: TargetEncoding) -> DataFrame:
    """Replace each feature by the mean of its level; unseen or null takes the overall mean."""
    columns = df.columns
    means = {}
    for i, (feature, lookup) in enumerate(encoding.lookups.items()):
        if feature not in columns:
            continue
        name = f"__te_{i}"
        renamed = LookupTable(
            lookup.table.withColumnRenamed("__mean", name), lookup.size_bytes, lookup.rows_seen,
            lookup.broadcast_limit)
        df = attach(df, feature, renamed, [name])
        steps = [F.col(name)]
        if encoding.when_null[feature] is not None:
            steps.append(F.when(c(feature).isNull(), F.lit(encoding.when_null[feature])))
        steps.append(F.lit(encoding.overall).cast("double"))
        means[feature] = F.coalesce(*steps).alias(feature)
    return df.select(*[means.get(name, c(name)) for name in columns])


# ---- one-hot encoding ----------------------------------------------------------


@dataclass
class OneHot:
    """``kept``: levels that stay themselves. ``dummies``: levels that got a column."""

    kept: dict[str, list[str]]
    dummies: dict[str, list[str]]
    null_as: str = "reference"

    def columns(self) -> list[str]:
        return [f"{f}_{level}" for f, levels in self.dummies.items() for level in levels]


def level_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, level, n)``; the null level is counted too, for the fill word."""
    return _levels(df, features).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


def rare_levels(counts: DataFrame, rare_below: int = RARE_BELOW) -> DataFrame:
    rare = counts.where(F.col("level").isNotNull())
    return rare.withColumn("is_rare", (F.col("n") < rare_below).cast("int"))


def fit_onehot(
    df: DataFrame,
    features: Sequence[str],
    rare_below: int = RARE_BELOW,
    null_as: str = "reference",
) -> OneHot:
    """Choose the dummy columns. The first level in sort order is the baseline for good,
    so that encoding a row never depends on which other rows are in the frame.

    Every dummy is a column of the plan, so more than ``COLUMN_LEVELS`` levels raise; none is dropped.
    ``sparse.fit_levels`` has no such bound."""
    features = [f for f in features if f in df.columns]
    if not features:
        return OneHot({}, {}, null_as)
    counts = materialize(level_counts(df, features), "levels")
    if not fits_columns(counts, rare_below):
        raise ValueError(f"more than {COLUMN_LEVELS} one-hot columns; encode them as a sparse vector instead")
    return onehot_from(counts, features, rare_below, null_as)


def _frequent(counts: DataFrame, rare_below: int) -> DataFrame:
    return counts.where(F.col("level").isNotNull() & (F.col("n") >= rare_below))


def fits_columns(counts: DataFrame, rare_below: int = RARE_BELOW) -> bool:
    return _frequent(counts, rare_below).limit(COLUMN_LEVELS + 1).count() <= COLUMN_LEVELS


def onehot_from(
    counts: DataFrame, features: Sequence[str], rare_below: int = RARE_BELOW, null_as: str = "reference"
) -> OneHot:
    """``fit_onehot`` from a stored table of level counts that fits columns."""
    rare = F.col("level").isNotNull() & (F.col("n") < rare_below)
    flags = {
        r["feature"]: r
        for r in counts.groupBy("feature").agg(
            F.max(F.col("level").isNull()).alias("nulls"), F.max(rare).alias("rare")).collect()
    }
    found = _frequent(counts, rare_below).select("feature", "level").collect()
    kept = {f: sorted(r["level"] for r in found if r["feature"] == f) for f in features}
    dummies = {}
    for f in features:
        levels = set(kept[f])
        if f in flags and flags[f]["rare"]:
            levels.add(RARE_TEXT)
        if f in flags and flags[f]["nulls"]:
            levels.add(FILL_TEXT)
        dummies[f] = sorted(levels)[1:]
    return OneHot(kept, dummies, null_as)


def grouped_level(df: DataFrame, feature: str, encoding: OneHot) -> Column:
    """The level after rare and unseen ones became the rare word."""
    value = F.coalesce(level_text(df, feature), F.lit(FILL_TEXT))
    stays = value.isin(encoding.kept[feature])
    if encoding.null_as == "unknown":
        stays = stays | c(feature).isNull()
    return F.when(stays, value).otherwise(F.lit(RARE_TEXT))


def group_rare(df: DataFrame, encoding: OneHot) -> DataFrame:
    return df.select(*[
        grouped_level(df, n, encoding).alias(n) if n in encoding.kept else c(n) for n in df.columns
    ])


def dummy_columns(df: DataFrame, encoding: OneHot, feature: str) -> dict[str, Column]:
    """Column name -> 0/1 expression of one feature."""
    grouped = grouped_level(df, feature, encoding)
    value = F.coalesce(level_text(df, feature), F.lit(FILL_TEXT))
    out = {}
    for level in encoding.dummies[feature]:
        # Only the rare word needs the whole list of kept levels.
        direct = level in encoding.kept[feature] and level != RARE_TEXT
        out[f"{feature}_{level}"] = ((value if direct else grouped) == F.lit(level)).cast("int")
    return out


def apply_onehot(df: DataFrame, encoding: OneHot) -> DataFrame:
    """Replace the features by their dummy columns, in one projection."""
    features = [f for f in encoding.dummies if f in df.columns]
    rest = [c(n) for n in df.columns if n not in encoding.dummies]
    dummies = [column.alias(name) for f in features
               for name, column in dummy_columns(df, encoding, f).items()]
    return df.select(*rest, *dummies)
