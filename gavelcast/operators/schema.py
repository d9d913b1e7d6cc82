"""Operators on column sets: decided on the driver from the schema, no data read."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import c

UNSAFE = re.compile(r"""[\[\]<>"'{},.:]""")
TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def classify(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and text column names, in table order."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def kept_columns(
    df: DataFrame, dropped: Sequence[str], encoded: Sequence[str], protected: Sequence[str] = ()
) -> list[str]:
    """Columns left once listed, time-typed and never-encoded text columns are gone."""
    kept = []
    for f in df.schema.fields:
        if f.name in protected:
            kept.append(f.name)
            continue
        unused_text = isinstance(f.dataType, T.StringType) and f.name not in encoded
        if f.name in dropped or isinstance(f.dataType, TIME_TYPES) or unused_text:
            continue
        kept.append(f.name)
    return kept


def drop_columns(
    df: DataFrame, dropped: Sequence[str], encoded: Sequence[str], protected: Sequence[str] = ()
) -> DataFrame:
    return df.select(*[c(name) for name in kept_columns(df, dropped, encoded, protected)])


def safe_names(names: Sequence[str]) -> list[str]:
    """Names without special characters; repeats get the first free number."""
    cleaned = [UNSAFE.sub("_", name) for name in names]
    reserved, used, out = set(cleaned), set(), []
    for name in cleaned:
        candidate, k = name, 0
        while candidate in used or (k and candidate in reserved):
            k += 1
            candidate = f"{name}_{k}"
        used.add(candidate)
        out.append(candidate)
    return out


def sanitize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def align(
    df: DataFrame, features: Sequence[str], targets: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Give the frame exactly the frozen features, in order, targets last.

    Absent features become 0 and are returned by name; extra columns go.
    """
    present = set(df.columns)
    added = [name for name in features if name not in present]
    chosen = [c(name) if name in present else F.lit(0).alias(name) for name in features]
    chosen += [c(name) for name in targets if name in present]
    return df.select(*chosen), added


def separate(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Feature columns and target column as two lazy views."""
    return df.drop(target), df.select(c(target))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace what is still missing in numeric columns by 0."""
    numeric, _ = classify(df)
    wanted = set(numeric if columns is None else columns)
    return df.select(*[
        F.coalesce(c(n), F.lit(0)).alias(n) if n in wanted else c(n) for n in df.columns
    ])
