import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from gavelcast.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", "a  b", "\n", "\n\n a", "a \n  b\n", "\u2581", "\u2581\u2581a", "a\u2581b \n\u2581", "<s> </s><0x0A>", "\x00", "\u3000x",
       "e\u0301", "\U0001f600 \U0001f44d\U0001f3fd", "a" * 9000, " " * 300, "\t\t x\r\ny", "a\nb", " \n", "\n\u2581x", "x \r\n);\r"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(-1, None)], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.counted(docs, PATH).collect()}
    for i, text in enumerate(ODD):
        n = len(library.encode(text))
        assert got[i] == (len(text.encode()), n, n > 4096), text
    assert got[-1] == (0, 0, False)


def test_the_test_table_equals_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = token_counts.counted(docs, PATH).collect()
    assert [r["n_tokens"] for r in rows] == [len(x) for x in library.encode([r["text"] for r in rows])]


def test_a_full_cache_starts_again(library):
    short = token_counts.Shortcut(open(PATH, "rb").read(), cached=len(token_counts.Shortcut(open(PATH, "rb").read()).single) + 3)
    text = " ".join(f"qzx{i}\nw{i}" for i in range(50))
    assert short.count(text) == len(library.encode(text)) and len(short) <= short.cached + 2


def test_empty(spark):
    assert token_counts.counted(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
