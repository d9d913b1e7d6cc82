"""Quality rules: base counts, and distance of a text's histograms from those of its language.

All of it is DataFrame expressions. ``measure`` counts per document; ``references`` sums the
counts of the documents that pass the base rules, per language; ``judge`` rejects a document
whose histogram of character classes, or of common words, lies further than a threshold (in
Jensen-Shannon distance, base 2, 0 to 1) from every reference. Texts shorter than a guard are
not judged by that histogram, because a short text is far from any reference by chance.

Defined cases: a null text has no words; it fails the base rules like any text of under
``MIN_WORDS`` words. A null or unknown language adds to no reference and is compared with all.
Repeated rows are judged each. Without any reference the base rules alone decide. Other columns
are passed through; an input column with the name of a result column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from ..runtime import materialize

# The most frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that it for".split(),
    "de": "der die und in den von zu das mit sich".split(),
    "fr": "de la le et les des en un du une".split(),
    "es": "de la que el en y a los se del".split(),
}
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
STOPS = ".,;:!?'\"()-"
CLASSES = ("lower", "upper", "other_letter", "digit", "blank", "stop", "symbol", "other")
WINDOW = 8
MIN_WORDS = 20
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Greatest distances kept, and the lengths from which they are looked at."""

    class_distance: float = 0.24
    min_chars: int = 300
    word_distance: float = 0.25
    min_words: int = 100


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _joined(hashes: str, width: int) -> Column:
    """Each hash combined with the one ``width`` places on."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + width)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``BASE``, ``base_failed``, ``class_counts`` and ``common_counts``."""
    kept = [name for name in docs.columns if name not in (*BASE, "base_failed", "class_counts", "common_counts")]
    body = F.coalesce(c(text), F.lit(""))
    vocabulary = common_words()

    # Runs of a-z are most of a text, so the other classes are counted in what they leave.
    step = docs.select(*[c(name) for name in kept], body.alias("_text"))
    step = step.select(
        "*", F.regexp_replace("_text", "[a-z]+", "").alias("_rest"),
        F.array_remove(F.split("_text", "[ \\t-\\r]+"), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"))
    step = step.select(
        "*", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.size("_words").cast("long").alias("n_words"), F.length("_text").alias("_chars"),
        _without(F.col("_rest"), BLANKS).alias("_solid"),
        F.concat(F.lit(" "), F.array_join(
            F.filter("_words", lambda w: w.isin(vocabulary)), "  "), F.lit(" ")).alias("_common"))
    # Hashes of 2, 4 and 8 neighbours; past the end a neighbour is missing, and those runs are cut off.
    for width in (1, 2, 4):
        step = step.withColumn("_hashes", _joined("_hashes", width))
    step = step.select(
        "*", F.when(F.col("n_words") > WINDOW, F.slice(
            "_hashes", F.lit(1), F.size("_hashes") - (WINDOW - 1))).alias("_runs"),
        F.regexp_replace("_solid", "[A-Z]+", "").alias("_odd"))
    step = step.select(
        "*", F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), F.sort_array(F.transform(
            "_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"),
        _without(F.col("_odd"), SYMBOLS).alias("_plain"))
    step = step.select(
        "*", F.sort_array(F.transform(
            F.filter("_sorted", lambda e, k: (F.get("_sorted", k - 1)["h"] == e["h"]).eqNullSafe(True)
                     | (F.get("_sorted", k + 1)["h"] == e["h"]).eqNullSafe(True)),
            lambda e: e["i"])).alias("_repeated"))

    # A repeated window covers its words up to where the next repeated window begins.
    steps = F.zip_with(F.slice("_repeated", 2, F.size("_repeated")), "_repeated", lambda after, before: F.least(
        F.coalesce(after - before, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)
    lengths = {name: F.length(name) for name in ("_rest", "_solid", "_odd", "_plain")}
    letters = F.length(F.regexp_replace("_plain", "[^\\x00-\\x7f]+", ""))
    no_stops = F.length(F.regexp_replace(_without(F.col("_plain"), STOPS), "[^\\x00-\\x7f]+", ""))
    digits = no_stops - F.length(F.regexp_replace(
        _without(F.col("_plain"), STOPS + "0123456789"), "[^\\x00-\\x7f]+", ""))
    classes = [F.col("_chars") - lengths["_rest"], lengths["_solid"] - lengths["_odd"],
               lengths["_plain"] - letters, digits, lengths["_rest"] - lengths["_solid"],
               letters - no_stops, lengths["_odd"] - lengths["_plain"], no_stops - digits]
    counts = [F.floor((F.length("_common") - F.length(F.replace(
        F.col("_common"), F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)) for w in vocabulary]
    step = step.select(
        *[c(name) for name in kept], "n_words",
        (F.col("_chars") - lengths["_rest"] + lengths["_solid"]).cast("long").alias("word_chars"),
        (lengths["_odd"] - lengths["_plain"]).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*[x.cast("long") for x in classes]).alias("class_counts"),
        F.array(*[x.cast("long") for x in counts]).alias("_counts"))
    used = F.aggregate("_counts", F.lit(0).cast("long"), lambda total, x: total + x)
    return step.select(
        *[c(name) for name in kept], *BASE,
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        "class_counts", F.concat("_counts", F.array(F.col("n_words") - used)).alias("common_counts"))


def common_words() -> list[str]:
    return sorted({word for words in COMMON_WORDS.values() for word in words})


def references(measured: DataFrame, lang: str = "lang") -> dict[str, tuple[list[float], list[float]]]:
    """Shares of classes and of common words per language with a word list.

    The result has one entry per such language, so it is small at every input size.
    """
    sizes = (("class_counts", len(CLASSES)), ("common_counts", len(common_words()) + 1))
    sums = [F.sum(F.get(name, F.lit(i))).cast("double").alias(f"{name}{i}") for name, n in sizes for i in range(n)]
    used = measured.where(~F.col("base_failed") & c(lang).isin(sorted(COMMON_WORDS)))
    found = {}
    for row in used.groupBy(c(lang).alias("_lang")).agg(*sums).collect():
        shares = []
        for name, n in sizes:
            counts = [row[f"{name}{i}"] for i in range(n)]
            shares.append([x / sum(counts) for x in counts])
        found[row["_lang"]] = tuple(shares)
    return found


def distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram of counts from shares."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda t, x: t + x)

    def of(total):
        def term(x, y):
            p = x / total
            middle = (p + y) / 2
            # Without a count the term is y * log2(y / (y / 2)), that is y.
            return F.when(x == 0, y).when(y > 0, p * F.log2(p / middle) + y * F.log2(y / middle)).otherwise(p)

        terms = F.zip_with(counts, F.array(*[F.lit(float(y)) for y in reference]), term)
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda t, x: t + x) / 2, F.lit(0.0)))

    # As an element of an array the total is summed once; named in ``term`` itself it would be summed again for every count.
    return F.when(total > 0, F.get(F.transform(F.array(total), of), F.lit(0)))


def judge(measured: DataFrame, known: dict, limits: Limits = Limits()) -> DataFrame:
    """Adds ``class_distance``, ``word_distance`` (each to the nearest reference) and ``kept``."""
    def nearest(column, index):
        found = [distance(F.col(column), known[lang][index]) for lang in sorted(known)]
        if not found:
            return F.lit(None).cast("double")
        return F.least(*found) if len(found) > 1 else found[0]

    chars = F.aggregate("class_counts", F.lit(0).cast("long"), lambda t, x: t + x)
    kept = [name for name in measured.columns if name not in ("class_distance", "word_distance", "kept")]
    step = measured.select(
        *[c(name) for name in kept],
        F.when(chars >= limits.min_chars, nearest("class_counts", 0)).alias("class_distance"),
        F.when(F.col("n_words") >= limits.min_words, nearest("common_counts", 1)).alias("word_distance"))
    far = (F.coalesce(F.col("class_distance") > limits.class_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > limits.word_distance, F.lit(False)))
    return step.withColumn("kept", ~F.col("base_failed") & ~far)


def final_references(measured: DataFrame, lang: str, limits: Limits) -> dict:
    """References without the documents that are far from those of all documents."""
    return references(judge(measured, references(measured, lang), limits).where("kept"), lang)


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None,
            limits: Limits = Limits()) -> DataFrame:
    """The verdict on each document, with the columns ``carry`` (default: all).

    The counts are written once to the shared folder, with what is carried: they are read for the references and
    again for the verdict. Stored columns also keep a filter on the verdict from being pushed into the
    expressions of the counts, where it would repeat them.
    """
    carry = docs.columns if carry is None else carry
    measured = measure(docs.select(*[c(n) for n in dict.fromkeys([*carry, lang, text])]), text)
    measured = measured.drop(*({text, lang} - set(carry) - {lang}))
    stored = materialize(measured, "quality")
    judged = judge(stored, final_references(stored, lang, limits), limits)
    return judged if lang in carry else judged.drop(lang)


def clean(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    ours = (*BASE, "base_failed", "class_counts", "common_counts", "class_distance", "word_distance", "kept")
    aside = {name: f"_own_{name}" for name in docs.columns if name in ours}
    found = quality(docs.withColumnsRenamed(aside), text, lang, limits=limits).where("kept").drop(*ours)
    return found.withColumnsRenamed({v: k for k, v in aside.items()}).select(*[c(name) for name in docs.columns])
