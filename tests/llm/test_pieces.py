import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gavelcast.llm import pieces

from . import plain

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def samples(spark, n):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()
    words = sorted({w for r in rows for w in r["text"].split()})
    return random.Random(3).sample(words, n)


def test_n_best_equals_all_segmentations(spark, vocabulary):
    for word in [*samples(spark, 40), "é\U0001f600x", "\x00a", "aaaa", "a\r"]:
        part = "\u2581" + word[:10]
        lattice = pieces.Lattices(vocabulary, [part])
        want = plain.segmentations(vocabulary, part, 4)
        assert pieces.n_best(vocabulary, part, 4) == want
        assert lattice.best()[0].tolist() == want[0][1]
        gap = lattice.gaps()[0]
        assert gap == (want[0][0] - want[1][0] if len(want) > 1 else np.inf)


def test_many_parts_at_once_equal_each_alone(spark, vocabulary):
    parts = ["\u2581" + w for w in samples(spark, 200)] + ["\n", "\u2581\u2581\u2581", "x" * 50, "\u2581\U0001f600"]
    lattices = pieces.Lattices(vocabulary, parts)
    ids, sizes = lattices.best()
    gaps = lattices.gaps()
    for part, own, gap in zip(parts, np.split(ids, np.cumsum(sizes)[:-1]), gaps):
        alone = pieces.Lattices(vocabulary, [part])
        assert alone.best()[0].tolist() == own.tolist() and alone.gaps()[0] == gap


def test_n_best_of_texts(vocabulary):
    for text in ("ab c", " a b", "a\nb c", "the cat", "é \U0001f600"):
        want = plain.segmentations(vocabulary, "\u2581" + text.replace(" ", "\u2581"), 5)
        for n in (1, 2, 3, 5):
            (ids, scores, others), = pieces.Encoder(MODEL, n).encode([text])
            assert scores == [score for score, _ in want[:n]] and ids.tolist() == want[0][1]
            assert len({tuple(x) for x in others} | {tuple(ids.tolist())}) == len(scores)


def test_round_trip_and_edges(spark, vocabulary):
    texts = [None, "", " ", "a  b\n\nc ", "<s>x</s>", "\x00\U0001f600\u3000", "q" * 3000, "a b " * 20000, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"ids": F.lit("mine"), "other": F.lit(1)})
    rows = pieces.encoded(docs, PATH, keep_others=True).collect()
    for r in rows:
        assert pieces.decode(vocabulary, r["ids"]) == (texts[r["doc_id"]] or "") and r["round_trip"] and r["n_pieces"] == len(r["ids"])
        for other in r["others"]:
            assert pieces.decode(vocabulary, other) == texts[r["doc_id"]]
        assert r["scores"] == sorted(r["scores"], reverse=True)
    assert pieces.encoded(docs.where("false"), PATH).count() == 0


def test_a_small_cache_changes_nothing(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    a = [(x.tolist(), s) for x, s, _ in pieces.Encoder(MODEL, 3, at_once=500, kept=50).encode(texts)]
    b = [(x.tolist(), s) for x, s, _ in pieces.Encoder(MODEL, 3).encode(texts)]
    assert a == b


def test_the_test_table_round_trips(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pieces.encoded(docs, PATH).select("round_trip", "n_pieces")
    assert rows.where("not round_trip").isEmpty() and rows.count() == docs.count()


def test_the_query_returns_every_segmentation(spark):
    """The best one as ``ids``, the others of the N best as ``others``."""
    from gavelcast.llm import catalog

    rows = catalog.QUERIES["op6_pieces"](spark, "/root/testdata/sf0.001").limit(20).collect()
    assert all(len(r["others"]) == len(r["scores"]) - 1 for r in rows)
    assert any(r["others"] for r in rows)
    assert all(other != r["ids"] for r in rows for other in r["others"])


def test_segmentations_stay_arrays(vocabulary):
    """No list of ids is made per text: the others are arrays of the ids' type, as the best one is."""
    (ids, _, others), = pieces.Encoder(MODEL, 3).encode(["é the cat \U0001f600 the cat"])
    assert len(others) == 2 and all(x.dtype == ids.dtype == np.int32 for x in others)
    assert all(pieces.decode(vocabulary, x) == "é the cat \U0001f600 the cat" for x in others)


def test_memory_of_new_pre_tokens_is_bounded():
    """The lattices of a text's new pre-tokens do not all exist at once."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(60_000))
    encoder = pieces.Encoder(MODEL, 3)
    tracemalloc.start()
    (ids, scores, _), = encoder.encode([text], False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces.decode(encoder.vocabulary, ids) == text and len(scores) == 3
    assert peak < 100e6
