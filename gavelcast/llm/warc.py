"""WARC archives as plain text files: written with revisit records, read by any number of tasks.

Writing: a record is one row of Spark's text writer with the record end as line separator, so each
task streams its rows into one archive. Of equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest id is a response and the others are revisits without a payload. Equal
payloads are found by digest and length; only the digests of payloads that occur twice meet the
payloads again, broadcast up to ``BROADCAST_DIGESTS`` of them and shuffled beyond that.

Reading: files are split anywhere. The text reader cuts at the magic ``WARC/1.1``; the lengths of the
cuts, summed in file order, give the byte offset of every magic. Each is a candidate record, and its
header tells the offset of its successor. A magic inside a payload is a candidate too, so candidates
are verified as a chain from the start of the file: candidates that follow each other without a gap
are contracted to runs within each split, and pointer jumping over the runs (its steps double, so
their number grows with the logarithm of the splits of one file) keeps what offset 0 leads to. A record
whose payload holds magics is put together from its cuts in a second read of those files.

Defined cases: a null payload is empty. Rows of equal payload that share the smallest id are all responses; a
null id is larger than any other. Line breaks in a URL are dropped. A last record that the file end
cuts short is not a record. Other columns are not written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import c
from ..runtime import materialize

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
MIN_REVISIT = 100
BROADCAST_DIGESTS = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(value: Column) -> Column:
    digits = F.sha2(F.concat(F.lit("page:"), F.coalesce(value.cast("string"), F.lit(""))), 256)
    parts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          date: str = "2024-01-01T00:00:00Z", broadcast_digests: int = BROADCAST_DIGESTS) -> None:
    """One record per row of ``pages`` into archives below ``path``."""
    body = F.coalesce(c(payload), F.lit(""))
    digests = pages.select(c(key).alias("id"), F.octet_length(body).alias("size"), F.sha2(body, 256).alias("digest"))
    repeated = materialize(
        digests.where(F.col("size") >= MIN_REVISIT).groupBy("digest", "size")
        .agg(F.min("id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "digests")
    small = repeated.count() <= broadcast_digests
    rows = pages.select(
        c(key).alias("id"), c(url).alias("url"), body.alias("body"), F.octet_length(body).alias("size"),
        F.sha2(body, 256).alias("digest"))
    rows = rows.join(F.broadcast(repeated) if small else repeated, ["digest", "size"], "left")
    revisit = F.coalesce(~F.col("id").eqNullSafe(F.col("original")) & F.col("original").isNotNull(), F.lit(False))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _uuid(F.col("id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _uuid(F.col("original"))),
            line("X-Refers-To-Page", F.col("original").cast("string")))).otherwise(""),
        line("X-Page-ID", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit("\r\n"), F.when(revisit, "").otherwise(F.col("body")))
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}: *(.*?)\r?$", 1), F.lit(""))


def _cuts(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics: ``(file, file_bytes, block, n, value)``, ``n`` in file order within a block."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("block")).withColumn("n", F.monotonically_increasing_id())


def _candidates(cuts: DataFrame, keep: list[str]) -> DataFrame:
    """Header fields of each cut, its payload as far as the cut holds it, and its length with the magic."""
    step = cuts.withColumn("head", F.substring_index("value", END, 1))
    size = F.octet_length("value").cast("long")
    head_bytes = F.octet_length("head").cast("long")
    step = step.select(
        *keep, "file", "file_bytes", "block", "n", size.alias("size"), head_bytes.alias("head_bytes"),
        # A cut without a header's end is none, however long; a header may have any length.
        F.when(size > head_bytes, F.col("head")).alias("head"), F.col("value").alias("raw"))
    step = step.withColumn("body_bytes", _header("Content-Length").try_cast("long"))
    span = F.col("head_bytes") + len(END) + F.col("body_bytes") + len(END)
    payload = F.substring(F.col("raw").cast("binary"), (F.col("head_bytes") + len(END) + 1).cast("int"),
                          F.col("body_bytes").cast("int"))
    return step.select(
        *keep, "file", "file_bytes", "block", "n", "size", "head_bytes", "body_bytes",
        span.alias("span"), (span == F.col("size")).alias("whole"),
        _header("WARC-Type").alias("type"), _header("WARC-Target-URI").alias("url"),
        _header("X-Page-ID").alias("page"), _header("X-Refers-To-Page").alias("refers_to"),
        _header("WARC-Payload-Digest").alias("digest_field"),
        F.when(span == F.col("size"), F.sha2(payload, 256)).alias("digest"))


def _placed(cut: DataFrame) -> DataFrame:
    """Adds ``at``, the byte offset of the magic before each cut; what lies before the first magic goes."""
    magic = len(MAGIC)
    blocks = cut.groupBy("file", "block").agg(F.sum(F.col("size") + magic).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("block_at", F.coalesce(F.sum("bytes").over(before), F.lit(0))).drop("bytes")
    earlier = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_at", F.coalesce(F.sum(F.col("size") + magic).over(earlier), F.lit(0)))
    # Each cut ends with the next magic, so the one before it begins a magic's length earlier.
    return (inside.join(blocks, ["file", "block"])
            .withColumn("at", F.col("_at") + F.col("block_at") - magic).drop("_at", "block_at").where("at >= 0"))


def _verified(placed: DataFrame) -> DataFrame:
    """The candidates that the chain of successors reaches from offset 0 of their file."""
    known = placed.where(F.col("span").isNotNull()).withColumn("next", F.col("at") + len(MAGIC) + F.col("span"))
    known = known.where(F.col("next") <= F.col("file_bytes"))
    order = Window.partitionBy("file", "block").orderBy("at")
    begins = F.coalesce((F.lag("next").over(order) != F.col("at")).cast("int"), F.lit(1))
    known = known.withColumn("_begins", begins).withColumn("run", F.sum("_begins").over(order)).drop("_begins")
    known = materialize(known, "candidates")

    exits = known.groupBy("file", "block", "run").agg(F.max_by("next", "at").alias("next"))
    entry = known.select("file", F.col("at").alias("next"), F.col("block").alias("to_block"), F.col("run").alias("to_run"))
    jump = materialize(exits.join(entry, ["file", "next"]).select(
        "file", "block", "run", "to_block", "to_run", F.col("next").alias("entry")), "jumps")
    reached = materialize(known.where("at = 0").select("file", "block", "run", F.col("at").alias("entry")), "reached")
    count = reached.count()
    while True:
        onward = reached.drop("entry").join(jump, ["file", "block", "run"]).select(
            "file", F.col("to_block").alias("block"), F.col("to_run").alias("run"), "entry")
        reached = materialize(
            reached.unionByName(onward).groupBy("file", "block", "run").agg(F.min("entry").alias("entry")), "reached")
        grown = reached.count()
        if grown == count:
            break
        count = grown
        second = jump.select("file", F.col("block").alias("to_block"), F.col("run").alias("to_run"),
                             F.col("to_block").alias("_b"), F.col("to_run").alias("_r"), F.col("entry").alias("_e"))
        jump = materialize(jump.drop("entry").join(second, ["file", "to_block", "to_run"]).select(
            "file", "block", "run", F.col("_b").alias("to_block"), F.col("_r").alias("to_run"),
            F.col("_e").alias("entry")), "jumps")
    return known.join(reached, ["file", "block", "run"]).where("at >= entry").drop("run", "entry")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, type, page, url, refers_to, payload_bytes, payload_digest)`` per record.

    Size and digest are those of the payload read, also for records whose payload holds magics. A
    revisit has an empty payload; ``digest_field`` is what its header says of the original's.
    """
    records = _verified(_placed(_candidates(_cuts(spark, path), [])))
    broken = records.where(~F.col("whole"))
    fields = ["file", "at", "type", "page", "url", "refers_to", "digest_field",
              F.col("body_bytes").alias("payload_bytes")]
    done = records.where("whole").select(*fields, F.col("digest").alias("payload_digest"))
    broken = materialize(broken.select(
        "file", "at", "next", "type", "page", "url", "refers_to", "digest_field", "head_bytes", "body_bytes"), "broken")
    if broken.isEmpty():
        return done
    files = [row[0] for row in broken.select("file").distinct().collect()]
    owner = broken.select("file", F.col("at").alias("owner"), "next")
    cuts = _placed(_candidates(_cuts(spark, files), ["value"])).select("file", "at", "value")
    # A cut belongs to the last broken record that begins at or before it, if it lies inside.
    marks = cuts.join(owner.withColumnRenamed("owner", "at"), ["file", "at"], "left").withColumn(
        "mark", F.when(F.col("next").isNotNull(), F.struct(F.col("at").alias("owner"), "next")))
    last = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = marks.withColumn("mark", F.last("mark", True).over(last)).where(F.col("at") < F.col("mark.next"))
    bodies = owned.groupBy("file", F.col("mark.owner").alias("at")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), MAGIC).alias("_raw"))
    block = F.substring(F.col("_raw").cast("binary"), (F.col("head_bytes") + len(END) + 1).cast("int"),
                        F.col("body_bytes").cast("int"))
    joined = broken.join(bodies, ["file", "at"])
    return done.unionByName(joined.select(*fields, F.sha2(block, 256).alias("payload_digest")))


def payloads(records: DataFrame) -> DataFrame:
    """``(page, payload_bytes, payload_digest, record_type, refers_to)``: revisits get what their original has."""
    first = records.where("type = 'response'").groupBy(F.col("page").alias("refers_to"), F.col(
        "payload_digest").alias("_digest")).agg(F.first("payload_bytes").alias("_bytes"))
    wanted = F.when(F.col("type") == "revisit", F.regexp_replace("digest_field", "^sha256:", ""))
    rows = records.withColumn("_digest", wanted).join(first, ["refers_to", "_digest"], "left")
    revisit = F.col("type") == "revisit"
    return rows.select(
        "page", F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit & F.col("_bytes").isNotNull(), F.col("_digest"))
        .when(~revisit, F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
