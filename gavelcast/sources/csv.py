"""Raw sales CSV in, report CSV out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import c
from ..params import FORCED_TEXT, NA_STRINGS

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"
# A quote inside a quoted field is doubled, as spreadsheets write it.
FORMAT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


def mangle_headers(names: Sequence[str | None]) -> list[str]:
    """Unique names by position: empty ones get ``Unnamed: i``, repeats a dotted number."""
    out, used = [], set()
    given = {name for name in names if name}
    for i, name in enumerate(names):
        base = name or f"Unnamed: {i}"
        candidate, k = base, 0
        while candidate in used or (k and candidate in given):
            k += 1
            candidate = f"{base}.{k}"
        used.add(candidate)
        out.append(candidate)
    return out


def normalize_nulls(df: DataFrame, na_strings: Sequence[str] = NA_STRINGS) -> DataFrame:
    """Turn missing-value words in text columns into nulls, NaN in numbers likewise."""
    out = []
    for f in df.schema.fields:
        column = c(f.name)
        if isinstance(f.dataType, T.StringType):
            column = F.when(~column.isin(*na_strings), column)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        out.append(column.alias(f.name))
    return df.select(*out)


def infer_types(df: DataFrame, forced_text: Sequence[str] = FORCED_TEXT) -> dict[str, str]:
    """Type per text column from all its values, in one aggregation.

    ``bigint`` where every value is whole and none is missing, ``double`` where
    every value present is a number, otherwise ``string``.
    """
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and f.name not in forced_text]
    if not names:
        return {}
    checks = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        whole = F.when(c(name).rlike(WHOLE), c(name).try_cast("bigint"))
        checks += [
            F.count(c(name)).alias(f"present{i}"),
            F.count_if(c(name).rlike(NUMBER)).alias(f"numbers{i}"),
            F.count(whole).alias(f"whole{i}"),
        ]
    found = df.agg(*checks).first()
    types = {}
    for i, name in enumerate(names):
        if found[f"numbers{i}"] < found[f"present{i}"]:
            types[name] = "string"
        elif found["rows"] and found[f"whole{i}"] == found["rows"]:
            types[name] = "bigint"
        else:
            types[name] = "double"
    return types


def breaks_lines(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether some line has an odd number of quotes, so that a quoted field spans lines."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return not lines.where(quotes % 2 == 1).isEmpty()


def headers(spark: SparkSession, path: str, options: dict) -> dict[tuple, list[str]]:
    """Files by their header row. One file is only peeked into; several are read once."""
    rows = spark.read.options(**options, header=False).csv(path)
    files = rows.inputFiles()
    if len(files) < 2:
        first = rows.first()
        return {tuple(first) if first is not None else (): files}
    cells = F.struct(*[c(n) for n in rows.columns])
    top = rows.select(cells.alias("cells"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("line")).where("block = 0")
    found: dict[tuple, list[str]] = {}
    for r in top.groupBy("file").agg(F.min_by("cells", "line").alias("cells")).orderBy("file").collect():
        header = list(r["cells"])
        found.setdefault(tuple(header), []).append(r["file"])
    return found


def read_sales(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    forced_text: Sequence[str] = FORCED_TEXT,
    na_strings: Sequence[str] = NA_STRINGS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read CSV with a header row in each file. A missing path raises.

    Files may order their columns differently; files of other columns raise, and so does a
    row with more fields than its header once it is read. Shorter rows end in missing values.

    Give ``types`` (column -> ``bigint``/``double``/``string``) for recurring loads; without it one
    extra pass infers them from the whole input. ``multi_line`` allows line breaks in quoted
    fields, at the price of one task per file; by default a pass over the lines finds out.
    """
    if multi_line is None:
        multi_line = breaks_lines(spark, path)
    options = {**FORMAT, "multiLine": multi_line}
    parts, expected = [], None
    for header, files in headers(spark, path, options).items():
        names = mangle_headers(list(header))
        expected = names if expected is None else expected
        if set(names) != set(expected):
            raise ValueError(f"files of different columns: {files[0]} lacks or adds {sorted(set(names) ^ set(expected))}")
        parts.append(_texts(spark, files or path, names, options))
    raw = parts[0]
    for part in parts[1:]:
        raw = raw.unionByName(part)
    clean = normalize_nulls(raw, na_strings)
    chosen = infer_types(clean, forced_text) if types is None else types
    return clean.select(*[
        c(n) if chosen.get(n, "string") == "string" else c(n).try_cast(chosen[n]).alias(n)
        for n in expected
    ])


def _texts(spark: SparkSession, files, names: list[str], options: dict) -> DataFrame:
    """All columns as text. The header is matched by position: its own names may be empty or repeated."""
    beyond = "__beyond_the_header"
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, beyond]])
    rows = spark.read.schema(texts).options(**options, header=True, enforceSchema=True).csv(files)
    wide = F.when(c(beyond).isNotNull(), F.raise_error(F.lit(f"a row has more than {len(names)} fields")).cast("boolean"))
    return rows.where(wide.otherwise(True)).drop(beyond)


def write_report(df: DataFrame, path: str) -> str:
    """Write a report table (a row per model, segment or bin) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
