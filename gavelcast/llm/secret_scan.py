"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more letters, digits and ``+/_-`` that holds a digit, or what a key word and ``=`` or ``:`` assign: a
value of 6 or more characters of any kind but blanks, up to the closing quote if it is quoted, else up to a quote, bracket, comma, semicolon, ``&``, ``<`` or ``>``. Of two candidates
of a word of which one holds the other, the longer counts. Its word and two
neighbours on each side give the forest's inputs: length, transitions between character classes, shares of the
classes, variety, coverage by a dictionary, path marks, and key or decoy words beside it. All of it is DataFrame expressions
and the forest is MLlib's; the forest is small and travels in the plan.

The forest is trained on labelled findings, ``(prefix, candidate, suffix, label)``. The tables hold none, so by default it
learns from ``labelled_findings``: ``FINDINGS`` rows of usual kinds of secrets and of look-alikes, made by Spark
from hashes of row numbers. Real findings can be passed instead.

Defined cases: a null or empty text has no candidates. Repeated rows get the same findings. Verdicts belong to an
id and text, so rows of one id and different texts keep apart; null ids work like any other.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import c
from ..runtime import materialize

CANDIDATE = r"(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}"
#: Shortest value that a key word assigns.
LEAST_VALUE = 6
#: Rows of labelled findings made for training, trees and their depth.
FINDINGS, TREES, DEPTH = 6000, 30, 7
BROADCAST_DOCS = 200_000
MASK = "[SECRET]"
# Words beside secrets, words beside look-alikes, and words that make up identifiers.
KEY_WORDS = "token secret password passwd pwd passphrase apikey api_key api access_key key auth credential bearer private".split()
DECOYS = "hash commit sha sha1 sha256 md5 checksum digest uuid guid id order invoice card phone isbn version build file path url example sample".split()
DICTIONARY = ("account address admin application archive article branch build button cache class client code column commit common config "
              "content context control country create custom data date default delete detail device document domain download element "
              "email error event example field file filter folder format function group handler header history image import index input "
              "install interface item language layout library list local manager member message method model module name network number "
              "object option order output package page parameter path pattern person place player plugin position private process product "
              "profile program project property public query report request resource response result return script search section "
              "server service session setting source staging standard start state status store string style summary support system table "
              "target template test text theme time title tool type update upload user utils value version video view window world").split()
# Words that follow a key word and a colon in prose and code.
VALUES = ("required optional string integer boolean undefined unknown missing invalid incorrect disabled enabled forgotten function "
          "return console window getenv important therefore because together something anything everything nothing another whether "
          "members school sector practice company lessons meeting events insurance healthcare education information details").split()
_ASSIGN = rf"(?i:(?:^|[^a-z0-9])(?:{'|'.join(sorted(KEY_WORDS, key=lambda w: -len(w)))})[\"'`\])]*\s*(?:=>|:=|==?|:)\s*)"
_QUOTED = "|".join(rf"(?<={q})[^{q}\s]{{{LEAST_VALUE},}}" for q in "\"'`")
_BARE = rf"(?<![\"'`])[^\s\"'`;,&<>()\[\]{{}}]{{{LEAST_VALUE - 1},}}[^\s\"'`;,&<>()\[\]{{}}.:]"
#: A value in the last word, group 1.
ASSIGNED = rf"{_ASSIGN}[\"'`]?({_QUOTED}|{_BARE})(?=\S*$)"
#: Texts that may hold such a value.
MAY_ASSIGN = rf"{_ASSIGN}\S{{{LEAST_VALUE},}}"
FEATURES = ("length", "transitions", "digits", "uppers", "lowers", "symbols", "hex_only", "digits_only", "variety", "dictionary",
            "slashes", "dashes", "path_mark", "known_prefix", "key_word", "decoy", "assigned", "quoted")


def with_features(findings: DataFrame) -> DataFrame:
    """Adds ``FEATURES`` (doubles) to rows ``(before, candidate, after, ...)``; ``before`` ends where the candidate begins."""
    token = F.col("candidate")
    length = F.length(token)

    def share(kept):
        return 1 - (F.length(F.regexp_replace(token, f"[{kept}]", "")) / length).cast("double")

    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A")
    beside = F.lower("before")
    word = r"(?:^|[^a-z0-9])(?:{})[^a-z0-9]*$"
    columns = {
        "length": length, "transitions": F.length(shape) / length, "digits": share("0-9"), "uppers": share("A-Z"),
        "lowers": share("a-z"), "symbols": share("^A-Za-z0-9+/_\\-"),
        "hex_only": token.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "digits_only": token.rlike("^[0-9_\\-]+$"),
        "variety": F.size(F.array_distinct(F.split(token, ""))) / length,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(token), "|".join(sorted(DICTIONARY, key=lambda w: -len(w))), "")) / length,
        "slashes": F.length(token) - F.length(F.translate(token, "/", "")),
        "dashes": F.length(token) - F.length(F.translate(token, "-_", "")),
        "path_mark": F.col("before").rlike(r"(?:[/\\~.:]|://\S*)$") | F.col("after").rlike(r"^(?:\.[A-Za-z]{1,5}\b|/)"),
        "known_prefix": token.rlike("^(?:AKIA|ASIA|ghp_|gho_|sk_live_|sk_test_|rk_live_|xox[abp]-|glpat-|eyJ|npm_|hf_)"),
        "key_word": beside.rlike(word.format("|".join(KEY_WORDS)) + "|" + "[_\\-.](?:token|secret|password|key)[^a-z0-9]*$"),
        "decoy": beside.rlike(word.format("|".join(DECOYS))),
        "assigned": F.col("before").rlike("[=:]\\s*[\"']?$"), "quoted": F.col("before").rlike("[\"']$"),
    }
    return findings.withColumns({name: columns[name].cast("double") for name in FEATURES})


def _random(kind: str, n: int, alphabet: str) -> Column:
    """``n`` characters of an alphabet, by hashes of the row's ``id``."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.substr(
        F.lit(alphabet), (F.pmod(F.xxhash64(F.col("id"), F.lit(kind), i), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))), "")


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """``(before, candidate, after, label)``: kinds of secrets (1) and look-alikes (0), in equal parts."""
    small, big, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexes, alnum = digits + "abcdef", digits + small + big

    def pick(kind, values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64("id", F.lit(kind)), F.lit(len(values))) + 1).cast("int"))

    def word(kind):
        return pick(kind, DICTIONARY)

    prose = F.concat(word("w1"), pick("gap", [" ", ", ", ". "]))
    key = F.concat(pick("key", KEY_WORDS[:-1]), pick("sign", ["=", " = ", ": ", '="', ' = "', ": '"]))
    key = F.when(F.pmod("id", F.lit(3)) == 0, F.upper(key)).otherwise(key)
    decoy = F.concat(pick("decoy", DECOYS), pick("dsign", [" ", " ", "=", ": ", ' = "', "/"]))
    number = F.concat(pick("year", ["2019", "2020", "2021", "2022", "2023"]), F.lit("0"), pick("month", list("123456789")))
    path = F.concat_ws("/", word("p1"), word("p2"), F.concat(word("p3"), number))
    name = F.concat_ws("_", word("n1"), word("n2"), word("n3"), F.substring(number, 3, 4))
    uuid = F.concat_ws("-", *[_random(f"u{i}", n, hexes) for i, n in enumerate((8, 4, 4, 4, 12))])
    kinds = [
        (key, _random("h40", 40, hexes), 1), (key, _random("h18", 18, hexes), 1), (key, _random("h32", 32, hexes), 1),
        (key, F.upper(_random("H40", 40, hexes)), 1), (key, _random("a24", 24, alnum), 1), (key, _random("a64", 64, alnum + "+/"), 1),
        (prose, F.concat(F.lit("AKIA"), _random("aws", 16, big + digits)), 1), (prose, F.concat(F.lit("ghp_"), _random("gh", 36, alnum)), 1),
        (prose, F.concat(F.lit("sk_live_"), _random("sk", 24, alnum)), 1), (prose, F.concat(F.lit("eyJ"), _random("jwt", 60, alnum + "-_")), 1),
        (key, F.concat(F.lit("AKIA"), _random("aws2", 16, big + digits)), 1),
        (key, _random("p8", 8, alnum), 1), (key, _random("p12", 12, alnum), 1), (key, _random("m10", 10, small + big), 1),
        (key, F.concat(_random("s3", 3, alnum), _random("s1", 1, "!$%@#*?.^~"), _random("s5", 5, alnum + "!$%@#*?.^~")), 1),
        (key, F.concat(_random("s8", 8, alnum + "!$%@#*?.^~"), _random("s2", 2, "!$%@#*?^~"), _random("s6", 6, alnum)), 1),
        (key, F.concat(word("h1"), _random("h2", 2, digits)), 1), (key, F.concat(pick("h3", VALUES), _random("h4", 3, digits)), 1),
        (key, _random("l20", 20, small), 1), (key, F.concat(word("l1"), pick("l2", VALUES), word("l3")), 1), (key, F.concat(_random("l12", 12, small), word("l4")), 1),
        (key, pick("v1", VALUES), 0), (key, word("v2"), 0), (key, F.initcap(pick("v3", VALUES)), 0), (key, F.concat(pick("v4", VALUES), F.lit("."), word("v5")), 0),
        (key, F.concat_ws("_", word("v6"), pick("v7", VALUES)), 0), (key, F.concat_ws("-", pick("v8", VALUES), word("v9")), 0), (key, F.upper(pick("v10", VALUES)), 0),
        (key, F.concat(F.lit("https://"), word("v11"), F.lit(".com/"), pick("v12", VALUES)), 0), (key, _random("v13", 8, small), 0),
        (decoy, _random("d40", 40, hexes), 0), (decoy, _random("d64", 64, hexes), 0), (decoy, uuid, 0), (prose, uuid, 0),
        (prose, _random("c16", 16, digits), 0), (prose, _random("c19", 19, digits), 0), (decoy, _random("c20", 20, digits), 0),
        (prose, path, 0), (F.concat(prose, F.lit("https://")), path, 0), (prose, name, 0), (prose, F.concat(word("m1"), word("m2"), word("m3"), number), 0),
    ]
    which = F.pmod(F.xxhash64("id", F.lit("kind")), F.lit(len(kinds)))
    cases = [F.when(which == i, F.struct(before.alias("before"), candidate.alias("candidate"), F.lit(label).cast("double").alias("label")))
             for i, (before, candidate, label) in enumerate(kinds)]
    made = spark.range(rows).select(F.coalesce(*cases).alias("row"), pick("after", ["", " and", '"', ".", ",", ' "', "'"]).alias("after"))
    return made.select("row.before", "row.candidate", "after", "row.label")


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assemble, forest]).fit(with_features(findings).coalesce(4))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text_hash, place, before, candidate, after)`` per candidate; ``place`` is its word's number."""
    rows = docs.select(c(key).alias("id"), F.sha2(c(text), 256).alias("text_hash"), c(text).alias("text")).where(
        F.col("text").rlike(CANDIDATE) | F.col("text").rlike(MAY_ASSIGN))
    rows = rows.select("id", "text_hash", F.split("text", "[ \\t-\\r]+").alias("words"))

    def beside(i):
        return F.concat_ws(" ", F.get("words", i - 2), F.get("words", i - 1), F.lit(""))

    found = rows.select("id", "text_hash", F.explode(F.filter(F.transform("words", lambda word, i: F.when(
        word.rlike(CANDIDATE) | (F.concat(F.coalesce(F.get("words", i - 1), F.lit("")), word).rlike("[=:]") & F.concat(beside(i), word).rlike(ASSIGNED)),
        F.struct(i.alias("place"), word.alias("word"), beside(i).alias("left"),
                 F.coalesce(F.get("words", i + 1), F.lit("")).alias("right")))), lambda x: x.isNotNull())).alias("x"))
    # A word may hold several candidates; each has the rest of the word and the neighbours beside it.
    found = found.select("id", "text_hash", "x.*").distinct().withColumns({
        "runs": F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), 1),
        "values": F.array_distinct(F.regexp_extract_all(F.concat("left", "word"), F.lit(ASSIGNED), 1))})
    alone = F.filter("runs", lambda run: ~F.exists("values", lambda value: F.contains(value, run)))
    values = F.filter("values", lambda value: ~F.exists("runs", lambda run: F.contains(run, value) & (run != value)))
    found = found.select("*", F.explode(F.concat(alone, values)).alias("candidate"))
    return found.select(
        "id", "text_hash", "place", F.concat("left", F.expr("substring(word, 1, locate(candidate, word) - 1)")).alias("before"), "candidate",
        F.concat(F.expr("substring(word, locate(candidate, word) + length(candidate))"), F.lit(" "), "right").alias("after"))


def judged(found: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``probability`` that a candidate is a secret, and ``secret``."""
    out = model.transform(with_features(found))
    likely = F.get(vector_to_array("probability"), F.lit(1))
    return out.select(*[c(n) for n in found.columns], likely.alias("probability"), (likely >= 0.5).alias("secret"))


def _per_text(docs: DataFrame, key: str, text: str, findings: DataFrame | None) -> DataFrame:
    spark = docs.sparkSession
    known = labelled_findings(spark) if findings is None else findings
    # The training rows are few; stored, every pass of the forest reads the same ones.
    model = train(materialize(known, "findings"))
    rows = judged(candidates(docs, key, text), model)
    return materialize(rows.groupBy("id", "text_hash").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.sum(F.col("secret").cast("long")).alias("n_secrets"),
        F.array_sort(F.collect_set(F.when(F.col("secret"), F.col("candidate")))).alias("secrets")), "found")


def _with_found(docs: DataFrame, key: str, text: str, found: DataFrame, broadcast_docs: int) -> DataFrame:
    found = found.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("n_candidates").alias("_candidates"),
                         F.col("n_secrets").alias("_secrets"), F.col("secrets").alias("_found"))
    if found.count() <= broadcast_docs:
        found = F.broadcast(found)
    return docs.join(found, (F.sha2(c(text), 256) == F.col("_hash")) & c(key).eqNullSafe(F.col("_id")), "left")


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", findings: DataFrame | None = None,
            broadcast_docs: int = BROADCAST_DOCS) -> DataFrame:
    """``(key, n_candidates, n_secrets, secrets)`` per row of ``docs``. Findings are few beside the texts and
    broadcast up to ``broadcast_docs`` documents that have some, counted first, and shuffled beyond."""
    own = docs.select(c(key), c(text))
    joined = _with_found(own, key, text, _per_text(own, key, text, findings), broadcast_docs)
    return joined.select(c(key), F.coalesce("_candidates", F.lit(0)).alias("n_candidates"), F.coalesce("_secrets", F.lit(0)).alias("n_secrets"),
                         F.coalesce("_found", F.array().cast("array<string>")).alias("secrets"))


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", findings: DataFrame | None = None,
           broadcast_docs: int = BROADCAST_DOCS) -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``, and the column ``length``, if there is one, brought up to date."""
    joined = _with_found(docs, key, text, _per_text(docs.select(c(key), c(text)), key, text, findings), broadcast_docs)
    # Longer ones first: a secret may hold another.
    longest = F.reverse(F.array_sort(F.transform("_found", lambda x: F.struct(F.length(x).alias("n"), x.alias("secret")))))
    clean = F.aggregate(longest, c(text), lambda body, x: F.replace(body, x["secret"], F.lit(MASK)))
    changed = F.coalesce(F.col("_secrets") > 0, F.lit(False))
    body = F.when(changed, clean).otherwise(c(text))
    out = joined.withColumn("_clean", body)
    columns = {text: F.col("_clean")}
    if length in docs.columns:
        columns[length] = F.when(changed, F.length("_clean").cast(docs.schema[length].dataType)).otherwise(c(length))
    return out.select(*[columns.get(n, c(n)).alias(n) for n in docs.columns])
