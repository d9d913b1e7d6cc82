import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gavelcast.llm import decontaminate, pieces, quality_rules
from gavelcast.llm.catalog import tokenizer

from . import plain

SMALL = "/root/testdata/sf0.001"


def test_equals_the_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.quality(docs).where("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    rows = [(i, t) for (i, t), (_, _, first) in zip(rows, plain.groups(rows, 5, 80)) if i == first]
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def leaks(text):
        words = lambda x: "".join(ch if ord(ch) > 127 or ch.isalnum() else " " for ch in x).lower().split()
        doc = words(text)
        there = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
        for item in map(words, items):
            if sum(tuple(item[i:i + 5]) in there for i in range(len(item) - 4)) > 2:
                if sum(n for _, _, n in plain.greedy_tiles(doc, item, 5)) >= 0.8 * len(item):
                    return True
        return False

    want = {i: t for i, t in rows if not leaks(t)}
    vocabulary = pieces.Vocabulary(open(tokenizer("piece_bpe_32k.model"), "rb").read())
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        text = pieces.decode(vocabulary, r["ids"])
        assert text == want[r["doc_id"]] or "[SECRET]" in text


@pytest.mark.parametrize("empty", [False, True])
def test_every_stage_takes_odd_rows(spark, tmp_path, empty):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c " * 50, None, None, 7), (3, "word " * 20000, "xx", "s", 1), (3, "word " * 20000, "xx", "s", 1),
            (None, "the of and to in a is that it for " + " ".join(f"w{i}" for i in range(40)), "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"ids": F.lit(1), "kept": F.lit("k"), "items": F.lit(2), "node": F.lit(3), "id": F.lit("i")})
    docs = docs.where("false") if empty else docs
    sf = str(tmp_path)
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        if name != "encode":
            assert out.columns == docs.columns, name
    kinds = [tuple(x) for x in spark.read.parquet(f"{sf}/encode").dtypes]
    assert ("ids", "array<int>") in kinds
    assert spark.read.parquet(f"{sf}/encode").count() == (0 if empty else 6)
    assert len(list(decontaminate.scan(decontaminate.Items([], []), pa.array(["x"])))) == 1
