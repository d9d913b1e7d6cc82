"""Column expressions: all stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def c(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def level_text(df: DataFrame, name: str) -> Column:
    """A column's values as category names; 3 and 3.0 are the same category.

    A fractional number that is whole is named like the whole number, so big keys stay apart.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        number = c(name).cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < 2.0 ** 53)
        return F.when(whole, number.cast("long").cast("string")).otherwise(c(name).cast("string"))
    return c(name).cast("string")


def flag_equals(column: Column, value) -> Column:
    """1 where the value is hit, else 0; missing counts as 0."""
    return F.when(column == F.lit(value), 1).otherwise(0)


def null_below(column: Column, bound) -> Column:
    """Missing where strictly below the bound."""
    return F.when(column >= F.lit(bound), column)


def has_value(column: Column) -> Column:
    return column.isNotNull().cast("int")


def extract_number(column: Column, pattern: str) -> Column:
    """First capture group as a double; missing where the pattern does not match.

    The empty string of a failed match is nulled before the cast: a failed cast
    costs an exception per row.
    """
    return F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")).try_cast("double")


def extract_numbers(column: Column, patterns: dict[str, str]) -> dict[str, Column]:
    return {name: extract_number(column, pattern) for name, pattern in patterns.items()}


def parse_date(column: Column, formats: Iterable[str]) -> Column:
    """First format that fits wins; missing where none does."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(fmt)) for fmt in formats])


def date_parts(column: Column, prefix: str = "Sale") -> dict[str, Column]:
    return {
        f"{prefix}_Year": F.year(column),
        f"{prefix}_Month": F.month(column),
        f"{prefix}_Quarter": F.quarter(column),
    }


def clip(column: Column, low: float, high: float) -> Column:
    """Bound a value. ``greatest`` and ``least`` skip nulls, hence the guard."""
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), column))
    return F.when(column.isNotNull(), bounded)


def log_target(column: Column) -> Column:
    return F.log1p(column)


def to_original_scale(column: Column) -> Column:
    return F.expm1(column)


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN in number columns becomes missing, as the CSV reader does it; other tables may hold some."""
    return df.select(*[
        nan_to_null(c(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c(f.name)
        for f in df.schema.fields])


def residual(actual: Column, predicted: Column) -> Column:
    return actual - predicted


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def percent_error(actual: Column, predicted: Column) -> Column:
    """Absolute error in percent of the actual value; missing where that is 0."""
    return F.try_divide(F.abs(actual - predicted), actual) * 100
