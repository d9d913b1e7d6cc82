import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gavelcast.llm import spelling

SMALL = "/root/testdata/sf0.001"


def plain_counts(rows, every, least=5, often=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, factor=2):
    lengths = {}
    for w in counts:
        lengths.setdefault(len(w), []).append(w)
    found = {}
    for w, n in counts.items():
        others = [o for k in (-1, 0, 1) for o in lengths.get(len(w) + k, []) if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        found[w] = (best if best is not None and counts[best] >= factor * n else None, len(others))
    out = []
    for w, n in counts.items():
        root, form = w, found[w][0]
        while found[root][0] is not None:
            root = found[root][0]
        out.append((w, form, root, n, found[w][1], counts[form] if form is not None else None))
    return sorted(out)


def variants(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.variants(words, **options).collect()))


def made_words(n, seed, alphabet="abeé", longest=8):
    rng = random.Random(seed)
    return {"".join(rng.choice(alphabet) for _ in range(rng.randint(3, longest))): rng.choice([1, 2, 3, 5, 8, 20, 50]) for _ in range(n)}


@pytest.mark.parametrize("every", [None, 97, 3])
def test_counts_equal_the_definition(spark, every):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "ÀÉÎ×÷ÿ Straße straße STRASSE naïve-Naïve"), (7, None), (8, ""), (9, "Abcde " * 1000), (9, "Abcde"), (10, "a" * 300000 + " İstanbul Kelvin")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(map(tuple, spelling.vocabulary(docs, damage_every=every).collect())) == plain_counts(rows, every)


def test_counting_in_small_portions(spark, monkeypatch):
    rows = [(i, "alpha beta gamma delta omega") for i in range(50)]
    monkeypatch.setattr(spelling, "HELD", 2)
    batches = spark.createDataFrame(rows, "doc_id long, text string").select(F.col("doc_id").cast("string"), "text").toArrow().to_batches(7)
    found = Counter()
    for batch in spelling._counted(iter(batches), 5, None):
        for word, n in zip(*(batch.column(i).to_pylist() for i in range(2))):
            found[word] += n
    assert found == plain_counts(rows, None)


def test_variants_equal_all_pairs(spark):
    for seed, alphabet in ((1, "ab"), (2, "abeé"), (3, "abcdefgÿß"), (4, "aα漢bà\U0001F600")):
        counts = made_words(500, seed, alphabet)
        assert variants(spark, counts) == plain_variants(counts)
    assert variants(spark, counts, factor=3) == plain_variants(counts, 3)


def test_cells_and_pieces_do_not_change_results(spark, monkeypatch):
    counts = made_words(700, 6)
    want = plain_variants(counts)
    for name, value in (("LEAF", 40), ("SAMPLE", 200), ("BUCKET", 3)):
        monkeypatch.setattr(spelling, name, value)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert max(len(t.cut) for t in spelling.cell_trees(words).values()) > 3
    # What a cell holds is bounded on the driver's side, so cells of 40 words and searches of 30 are cut in pieces.
    monkeypatch.setattr(spelling, "SEARCHES", 30)
    assert variants(spark, counts) == want


def test_defined_cases(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).collect() == []
    long = {"x" * 40000: 9, "x" * 39999 + "y": 3, "x" * 40001: 2, "y" * 40000: 1}
    assert variants(spark, long) == plain_variants(long)
    ties = {"abcde": 1, "abcdx": 5, "abcdé": 5, "abcda": 5, "abcdeeee": 1}
    assert variants(spark, ties) == plain_variants(ties)


def test_a_chain_of_forms_leads_to_one_root(spark):
    counts = {"a" * (5 + i): 2 ** i for i in range(12)}
    got = variants(spark, counts)
    assert got == plain_variants(counts) and {r[2] for r in got} == {"a" * 16}


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clashing = docs.withColumns({n: F.lit(1) for n in ("word", "n", "near", "cell", "length")})
    want = plain_variants(plain_counts([tuple(r) for r in docs.select("doc_id", "text").collect()], 97))
    assert any(r[1] for r in want)
    assert sorted(map(tuple, spelling.grouped(clashing, damage_every=97).collect())) == want
    assert spelling.grouped(docs.where("false")).collect() == []
