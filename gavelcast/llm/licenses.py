"""License scans: ordered signatures over normalised text, gated by keys, with contained detections suppressed.

All of it is DataFrame expressions on one row at a time, so a scan is one pass without a shuffle. A text is lower-cased
and its separators become single blanks. ``KEYS`` present in it select the rules (``license_rules``) that can match at all;
only those regexes run. A match is marked in the text, and the marked words give its place, so places cost the same for
one match and for very many. Detections are sorted by start, then longest, highest priority, and first rule. In that
order everything that can suppress a detection comes before it: one goes if an earlier one of at least its priority
reaches as far as it does. Running ends per priority decide that in one pass.

The base phrases are looked for beside the rules: their places are counted, and their labels always stay.

Defined cases. A null text is empty: no words, no labels, score 0. Texts may have any length; the places of a rule are
linear in the words. Repeated rows are scanned each, and an empty table gives an empty result. Lower-casing is full
Unicode, but nothing outside A-Z becomes a letter of a base phrase. Other columns are passed through; one with the name
of a result column is replaced by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from .license_rules import WEIGHTS, rules

# Decided phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_WEIGHT = 0.5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Cannot stand in normalised text, where it would be a separator.
MARK = "\x01"
#: Detections are gathered in lists of so many, so that appending stays cheap.
PORTION = 256
RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
FOUND = "struct<start:int,less_end:int,less_priority:int,rule:int,label:string>"


def normalised(text: Column) -> Column:
    """Lower case, single blanks between words, a blank at either end."""
    # The Kelvin sign is the one other character that lower-casing turns into a plain letter.
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Ⓚ")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, SEPARATORS, " ")), F.lit(" "))


def whole_words(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


def marked_places(norm: Column, regex: Column) -> Column:
    """Numbers of the words at which a regex matches, in order."""
    # The text begins with a blank, so the first piece is empty and word 0 is piece 1.
    words = F.split(F.regexp_replace(norm, regex, F.lit(MARK + "$0")), " ")
    return F.filter(F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i - 1)), lambda i: i.isNotNull())


def _rule_table() -> Column:
    return F.array(*[F.struct(
        F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.key).alias("key"),
        F.lit(whole_words(r.regex)).alias("regex")) for i, r in enumerate(rules())])


def found_by(norm: Column, rule: Column) -> Column:
    """The detections of one rule, as sortable structs."""
    matches = F.call_function("regexp_extract_all", norm, rule["regex"], F.lit(0))
    lengths = F.transform(matches, lambda m: F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit(""))) + 1)
    return F.zip_with(marked_places(norm, rule["regex"]), lengths, lambda at, n: F.struct(
        at.alias("start"), (-(at + n)).alias("less_end"), (-rule["priority"]).alias("less_priority"),
        rule["rule"].alias("rule"), rule["label"].alias("label")))


def kept_only(found: Column) -> Column:
    """Sorted detections without those inside one of at least their priority."""
    levels = sorted(WEIGHTS)
    none = F.array().cast(f"array<{FOUND}>")
    start = F.struct(*[F.lit(0).alias(f"end{p}") for p in levels], none.alias("part"), F.array().cast(f"array<array<{FOUND}>>").alias("full"))

    def step(state, x):
        end, priority = -x["less_end"], -x["less_priority"]
        inside = reduce(lambda a, b: a | b, [(priority <= p) & (state[f"end{p}"] >= end) for p in levels])
        large = F.size(state["part"]) >= PORTION
        return F.struct(
            *[F.when(priority == p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}") for p in levels],
            F.when(inside, state["part"]).when(large, F.array(x)).otherwise(F.concat(state["part"], F.array(x))).alias("part"),
            F.when(large & ~inside, F.concat(state["full"], F.array(state["part"]))).otherwise(state["full"]).alias("full"))

    return F.aggregate(found, start, step, lambda s: F.concat(F.flatten(s["full"]), s["part"]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``RESULT``; a detection is ``(label, rule, priority, start, end)`` in words, the end exclusive."""
    aside = [name for name in docs.columns if name not in RESULT]
    step = docs.select(F.struct(*[c(name) for name in aside]).alias("row"), normalised(c(text)).alias("norm"))
    blanks = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit("")))
    base = F.lit(whole_words("|".join(PHRASES)))
    in_base = reduce(lambda a, b: a | b, [F.contains("norm", F.lit(f" {p} ")) for p in PHRASES])
    keys = F.array(*[F.lit(k) for k in sorted({r.key for r in rules()})])
    step = step.select(
        "row", "norm", F.when(F.trim("norm") == "", 0).otherwise(blanks - 1).cast("long").alias("n_words"),
        F.when(in_base, marked_places(F.col("norm"), base)).otherwise(F.array().cast("array<int>")).alias("places"),
        F.array_compact(F.array(*[F.when(F.contains("norm", F.lit(f" {p} ")), F.lit(label)) for p, label in PHRASES.items()])).alias("base"),
        F.filter(keys, lambda k: F.contains(F.col("norm"), k)).alias("present"))
    chosen = F.filter(_rule_table(), lambda r: F.array_contains(F.col("present"), r["key"]))
    hits = F.flatten(F.transform(chosen, lambda r: found_by(F.col("norm"), r)))
    step = step.select(
        "row", "n_words", "places", "base", F.when(F.size("present") > 0, F.sort_array(hits)).otherwise(
            F.array().cast(f"array<{FOUND}>")).alias("hits"))
    step = step.select("row", "n_words", "places", "base", F.when(F.size("hits") > 0, kept_only(F.col("hits"))).otherwise(F.col("hits")).alias("kept"))
    step = step.select("*", F.array_sort(F.array_union("base", F.transform("kept", lambda x: x["label"]))).alias("all"))

    def chance(label):
        """What is left of the doubt after a label: 1 less its weight, by its best rule."""
        best = F.array_max(F.transform(F.filter("kept", lambda x: x["label"] == label), lambda x: -x["less_priority"]))
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair]), best), F.lit(0.0))
        return 1.0 - F.greatest(weight, F.when(F.array_contains("base", label), BASE_WEIGHT).otherwise(0.0))

    doubt = F.aggregate(F.transform("all", chance), F.lit(1.0), lambda a, x: a * x)
    return step.select(
        *[F.col("row")[name].alias(name) for name in aside], "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join("all", ",").alias("labels"),
        (1.0 - doubt).alias("score"),
        F.transform("kept", lambda x: F.struct(
            x["label"].alias("label"), x["rule"].alias("rule"), (-x["less_priority"]).alias("priority"), x["start"].alias("start"),
            (-x["less_end"]).alias("end"))).alias("detections"))
