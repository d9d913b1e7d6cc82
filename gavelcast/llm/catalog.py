"""Registered queries of this folder and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import runtime
from ..runtime import ship
from . import (
    decontaminate, hard_negatives, licenses, ngram_join, passages, pieces, quality_model, quality_rules,
    secret_scan, spelling, token_counts, url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.quality(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance", "kept")


# Decided rules (verdict, host and beginning of the path).
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


@query
def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).drop("url")


def _fits(rule: str) -> str:
    host, slash, path = rule.partition("/")
    return f"(host = '{host}' or host like '%.{host}') and starts_with(path, '{slash}{path}')"


SQL["op2_url_filter"] = f"""
with parts as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages)
select page_id, host, path, rule,
       case {" ".join(f"when rule = '{r}' then '{v}'" for v, r in URL_RULES)} else 'allow' end as verdict
from (select *, case {" ".join(f"when {_fits(r)} then '{r}'" for v, r in sorted(URL_RULES, key=lambda x: -len(x[1])))}
      end as rule from parts)
"""


@query
def op4_token_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.counted(documents, tokenizer("piece_bpe_32k.model")).drop("text")


@query
def op6_pieces(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded(documents, tokenizer("piece_bpe_32k.model"), keep_others=True).drop("text")


@query
def op8_warc(spark, sf_dir):
    path = runtime.scratch_path(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.payloads(warc.read(spark, path))
    return found.select(
        F.col("page").cast("long").alias("page_id"), F.col("payload_bytes").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


SQL["op8_warc"] = """
with p as (select page_id, coalesce(html, '') as body from pages),
     d as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest from p),
     o as (select *, case when payload_bytes >= 100
                          then min(page_id) over (partition by payload_digest, payload_bytes) end as original from d)
select page_id, payload_bytes, payload_digest,
       case when original is not null and original <> page_id then 'revisit' else 'response' end as record_type,
       case when original is not null and original <> page_id then original end as refers_to
from o
"""


@query
def op1_ngram_join(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.groups(documents).withColumnRenamed("id", "doc_id")


@query
def op5_quality_model(spark, sf_dir):
    return quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])


@query
def op3_passages(spark, sf_dir):
    return passages.marked(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark, sf_dir):
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


@query
def op11_spelling(spark, sf_dir):
    return spelling.grouped(table(spark, sf_dir, "documents"), damage_every=97)


@query
def op12_licenses(spark, sf_dir):
    documents = runtime.spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return licenses.scan(documents).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")


@query
def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


SQL["op13_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
         cast(list_sum(list_transform(list_zip(a.q, r.q), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
p as (
  select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select * from (
  select p.anchor_id, p.vec_id as positive_id,
         cast(row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as int) as rank,
         s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
  from p join s on s.anchor_id = p.anchor_id and not s.same
    and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
where rank <= 5
"""


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
