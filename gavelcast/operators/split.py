"""Train / validation / test assignment by key hash.

The side of a row depends on its key and the seed only, so it survives
repartitioning, retries and new rows arriving later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from ..functions.quantiles import values_at_ranks
from ..params import SEED, SPLIT_RATIOS
from ..runtime import materialize

HEX_DIGITS = 13  # 52 bits: exact in a double


def unit_hash(key: str | Sequence[str], seed: int = SEED) -> Column:
    """Uniform number in [0, 1) from the key."""
    names = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[c(name).cast("string") for name in names], F.lit(str(seed)))
    digits = F.substring(F.md5(text), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**HEX_DIGITS))


def _side(position: Column, train_end: float, validation_end: float, inclusive: bool) -> Column:
    def upto(end):
        return position <= F.lit(end) if inclusive else position < F.lit(end)

    return F.when(upto(train_end), "train").when(upto(validation_end), "val").otherwise("test")


def hash_split(df: DataFrame, key, ratios=SPLIT_RATIOS, seed: int = SEED) -> DataFrame:
    """Add ``split``; sizes follow the ratios in expectation. No shuffle."""
    train, validation, _ = ratios
    side = _side(unit_hash(key, seed), train, round(train + validation, 12), inclusive=False)
    return df.withColumn("split", side)


def split_sizes(n: int, ratios=SPLIT_RATIOS) -> tuple[int, int, int]:
    """Train gets the floor of its share; the rest is divided, test taking the odd row."""
    train_share, validation_share, test_share = ratios
    train = int(n * train_share)
    rest = n - train
    validation = int(rest * validation_share / (validation_share + test_share) + 1e-9)
    return train, validation, rest - validation


def exact_split(df: DataFrame, key, ratios=SPLIT_RATIOS, seed: int = SEED) -> DataFrame:
    """Add ``split`` with exactly the sizes of ``split_sizes``.

    The two cut values are order statistics of the hash, found by counting; the
    rows themselves are neither sorted nor shuffled. Where the key repeats at a cut, the
    rows tied there are ranked by a hash of the whole row, and equal rows by their place in a
    stored copy, which is written only then. So lines of one key part at a cut and nowhere else.
    """
    hashed = df.select(unit_hash(key, seed).alias("h"))
    ends = []

    def ranks(n):
        train, validation, _ = split_sizes(n, ratios)
        ends.extend((train - 1, train + validation - 1))
        return [max(r, 0) for r in ends] if n else []

    cuts = values_at_ranks(hashed, "h", ranks)
    first, second = [cuts[r] if r >= 0 else -1.0 for r in ends]

    below = hashed.agg(
        F.count_if(F.col("h") <= first).alias("a"), F.count_if(F.col("h") <= second).alias("b")
    ).first()
    if (below["a"], below["b"]) == (ends[0] + 1, ends[1] + 1):
        return df.withColumn("split", _side(unit_hash(key, seed), first, second, inclusive=True))
    return _split_ties(df, unit_hash(key, seed), ends)


def _split_ties(df: DataFrame, hashed: Column, ends: Sequence[int]) -> DataFrame:
    """``exact_split`` at the zero-based ranks ``ends`` where hashes repeat."""
    columns = df.columns
    row_hash = F.pmod(F.xxhash64(*[c(n) for n in columns]), F.lit(1 << 52)).cast("double")
    ranked = {"__key": hashed, "__row": row_hash}
    cuts = _cuts(df.select(*[column.alias(name) for name, column in ranked.items()]), ends)
    if cuts is None:
        df = materialize(df.withColumn("__place", F.monotonically_increasing_id()), "split")
        ranked["__place"] = F.col("__place").cast("double")
        cuts = _cuts(df.select(*[column.alias(name) for name, column in ranked.items()]), ends)

    def upto(cut):
        inside = F.lit(True)
        for column, value in reversed(list(zip(ranked.values(), cut))):
            inside = (column < value) | ((column == value) & inside)
        return inside if cut else F.lit(False)

    side = F.when(upto(cuts[0]), "train").when(upto(cuts[1]), "val").otherwise("test")
    return df.withColumn("split", side).select(*[c(n) for n in columns if n != "split"], "split")


def _cuts(rows: DataFrame, ends: Sequence[int]) -> list[list[float]] | None:
    """For each rank the values, column by column, up to which rows count; ``None`` if the columns do not tell rows apart."""
    out = []
    for end in ends:
        tied, cut = rows, []
        for column in rows.columns if end >= 0 else ():
            value = values_at_ranks(tied, column, lambda n: [end])[end]
            cut.append(value)
            count = tied.agg(F.count_if(F.col(column) < value).alias("a"), F.count_if(F.col(column) <= value).alias("b")).first()
            if count["b"] == end + 1:
                break
            tied, end = tied.where(F.col(column) == value), end - count["a"]
        else:
            if end >= 0:
                return None
        out.append(cut)
    return out
