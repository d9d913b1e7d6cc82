"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, A-Z lower-cased, so changed punctuation hides nothing. A benchmark item and a
document share a seed where ``LEAST`` words in a row have the same Karp-Rabin hash. For items whose seeds could
cover enough of them, the longest match of unmarked words is marked as a tile, again and again, until none of
``LEAST`` words is left. The tiles' share of the item's words is the coverage; it does not depend on the order of
the tiles in the document, so a passage whose sentences were rearranged is still found.

The benchmark is collected and broadcast in blocks of at most ``BLOCK_WORDS`` words, some 40 bytes each, and the documents
are read once for each block; a benchmark up to that size is one block. Documents are neither shuffled nor grouped.

Defined cases: a null or empty text shares nothing. An item of fewer than ``LEAST`` words is matched by its whole
word sequence; one without words, or with a null text or id, is skipped. Items of equal text are each reported. Repeated
rows are judged each. Result columns replace input columns of the same names.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import c
from ..runtime import materialize
from .tokens import ALNUM, slices, windows, word_hashes

LEAST = 5
COVERED = 0.8
BLOCK_WORDS = 2_000_000
FOUND = ("items", "coverage", "n_tiles", "contaminated")


class Items:
    """The items of one block, with the places of their seeds."""

    def __init__(self, ids: list[int], words: list[np.ndarray], least: int = LEAST):
        self.ids, self.words, self.least = ids, words, least
        seeds, owners, places = [], [], []
        for i, own in enumerate(words):
            found = windows(own, least)
            seeds.append(found)
            owners.append(np.full(len(found), i))
            places.append(np.arange(len(found)))
        seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.places = np.concatenate(places)[order] if places else np.zeros(0, np.int64)


def tiles(matches: Iterable[tuple[int, int, int]], item_words: int, doc_words: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item place, document place, length)`` of maximal matches, longest first, then by place."""
    heap = [(-n, i, j) for i, j, n in matches]
    heapq.heapify(heap)
    item_free, doc_free = np.ones(item_words, bool), np.ones(doc_words, bool)
    found = []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = item_free[i:i - n] & doc_free[j:j - n]
        if free.all():
            item_free[i:i - n] = doc_free[j:j - n] = False
            found.append((i, j, -n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(heap, (a - b, i + a, j + a))
    return found


def maximal(pairs: Iterable[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Maximal matches of places ``(item, document)`` whose runs of ``least`` words are equal."""
    diagonals = defaultdict(list)
    for i, j in pairs:
        diagonals[j - i].append(i)
    out = []
    for shift, places in diagonals.items():
        places.sort()
        begin = last = places[0]
        for i in places[1:] + [-2]:
            if i != last + 1:
                out.append((begin, begin + shift, last - begin + least))
                begin = i
            last = i
    return out


def scan(items: Items, texts: pa.Array, covered: float = COVERED) -> Iterator[list[tuple[int, float, int]]]:
    """Per text, ``(item id, coverage, tiles)`` of each item covered enough."""
    least = items.least
    hashes, first = word_hashes(texts, ALNUM)
    runs = windows(hashes, least)
    if len(items.seeds):
        at = np.minimum(np.searchsorted(items.seeds, runs), len(items.seeds) - 1)
        hits = np.flatnonzero(items.seeds[at] == runs)
    else:
        hits = np.zeros(0, np.int64)
    text_of = np.searchsorted(first, hits, "right") - 1
    inside = hits + least <= first[text_of + 1]
    hits, text_of = hits[inside], text_of[inside]
    cuts = np.searchsorted(text_of, np.arange(len(first)))
    shortest = {n: [k for k, own in enumerate(items.words) if len(own) == n] for n in range(1, least)}
    for i in range(len(first) - 1):
        found = _text(items, runs, hits[cuts[i]:cuts[i + 1]], int(first[i]), int(first[i + 1] - first[i]), covered)
        own = hashes[first[i]:first[i + 1]]
        for n, which in shortest.items():
            if which and len(own) >= n:
                there = set(windows(own, n).tolist())
                found += [(items.ids[k], 1.0, 1) for k in which if int(windows(items.words[k], n)[0]) in there]
        yield sorted(found)


def _text(items: Items, runs, hits, begin: int, n_words: int, covered: float) -> list[tuple[int, float, int]]:
    least, pairs = items.least, defaultdict(list)
    if not len(hits):
        return []
    lo = np.searchsorted(items.seeds, runs[hits])
    hi = np.searchsorted(items.seeds, runs[hits], "right")
    for j, a, b in zip((hits - begin).tolist(), lo.tolist(), hi.tolist()):
        for k in range(a, b):
            pairs[int(items.owners[k])].append((int(items.places[k]), j))
    found = []
    for item, places in pairs.items():
        size = len(items.words[item])
        reach = np.zeros(size, bool)
        for i in {i for i, _ in places}:
            reach[i:i + least] = True
        # Tiles lie inside what seeds cover, so this bounds the coverage from above.
        if reach.sum() < covered * size:
            continue
        laid = tiles(maximal(places, least), size, n_words, least)
        share = sum(n for _, _, n in laid) / size
        if share >= covered:
            found.append((items.ids[item], share, len(laid)))
    return found


def _blocks(benchmark: DataFrame, key: str, text: str, least: int, block_words: int) -> Iterator[Items]:
    known = benchmark.select(c(key).cast("long").alias("id"), c(text).alias("text")).where("id is not null and text is not null")
    # A word takes two bytes of text at least.
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))
    for block in range(blocks):
        own = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id").toArrow()
        hashes, first = word_hashes(own.column("text").combine_chunks() if len(own) else pa.array([], pa.string()), ALNUM)
        words = [hashes[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        filled = [(i, w) for i, w in zip(own.column("id").to_pylist(), words) if len(w)]
        yield Items([i for i, _ in filled], [w for _, w in filled], least)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", carry: list[str] | None = None, covered: float = COVERED,
                 least: int = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns ``carry`` (default: all) with ``items`` found (ids), the largest ``coverage``, its ``n_tiles``, and ``contaminated``."""
    carry = [name for name in (docs.columns if carry is None else carry) if name not in FOUND]
    kind = pa.list_(pa.struct([("item", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64())]))
    found = T.StructField("_found", T.ArrayType(T.StructType([
        T.StructField("item", T.LongType()), T.StructField("coverage", T.DoubleType()), T.StructField("tiles", T.LongType())])))
    result = docs.select(*[c(name) for name in carry], c(text).alias("_text"), F.lit(None).cast(found.dataType).alias("_found"))

    def against(sent):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(slices(batch, len(carry)) for batch in batches):
                texts, earlier = batch.column(len(carry)), batch.column(len(carry) + 1).to_pylist()
                cells = [(own or []) + [dict(item=i, coverage=s, tiles=n) for i, s, n in more]
                         for own, more in zip(earlier, scan(sent.value, texts, covered))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cells, kind)], names=batch.schema.names)
        return run

    blocks = _blocks(benchmark, item_key, item_text, least, block_words)
    for k, items in enumerate(blocks):
        if k:
            result = materialize(result, "tiled")
        sent = docs.sparkSession.sparkContext.broadcast(items)
        result = result.mapInArrow(against(sent), result.schema)
    best = F.array_max(F.transform("_found", lambda x: F.struct(x["coverage"], -x["tiles"])))
    return result.select(
        *[c(name) for name in carry], F.array_sort(F.transform("_found", lambda x: x["item"])).alias("items"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.coalesce(-best["col2"], F.lit(0)).cast("long").alias("n_tiles"), (F.size("_found") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    judged = contaminated(docs.withColumnsRenamed({n: f"_own_{n}" for n in docs.columns if n in FOUND}), benchmark, **options)
    kept = judged.where(~F.col("contaminated")).drop(*FOUND)
    return kept.withColumnsRenamed({f"_own_{n}": n for n in docs.columns if n in FOUND}).select(*[c(n) for n in docs.columns])
