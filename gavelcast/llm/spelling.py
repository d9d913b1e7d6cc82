"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's vector of letter counts by at most 2 in L1 distance: a
replacement adds one to a count and takes one from another, an insertion adds one. So the words near a word are among
those of its own length within one up and one down, and those one letter longer within one up (the shorter ones are found
from their side). Each length has a tree. A search goes down only into boxes that the word's vector can reach with
what it may add and take away, compares count vectors in the buckets, and verifies the order of letters of what is left.

A length of more than ``LEAF`` words is cut into cells by a tree fitted on at most ``SAMPLE`` words; all words are put
into its cells and searched in every cell within reach, so the sample decides about balance and never about results. A
cell with its searches is the unit of work: its words are held in a tree of their own, and searches stream by. A cell
that has got too many words, letters or searches is cut in pieces that meet all its searches. The cells' tree is the
only thing broadcast, at most ``SAMPLE`` / 16 leaves.

Defined cases. A null text has no words. A null id counts as an empty string in the checksum. Texts and words may have any
length; a task counts at most ``LETTERS`` letters, or ``HELD`` words, besides one text before it passes them on. Repeated rows are counted each. Ties among near
words of equal counts go to the first in code-point order. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from ..runtime import materialize

LETTERS_OF_A_WORD = "a-zÀ-ÿ"
DIMENSIONS = 90
#: Words of a cell, and of a bucket of its tree.
LEAF = 4096
BUCKET = 64
#: Words from which the trees of cells are fitted.
SAMPLE = 1 << 16
#: Searches of a cell that one task takes, and letters of its words.
SEARCHES = 1 << 16
CELL_LETTERS = LEAF * 64
#: Distinct words that a counting task holds, and letters of text it counts before it passes them on.
HELD = 1 << 18
LETTERS = 1 << 26
#: Numbers compared at once.
NUMBERS = 1 << 22
#: A search of the own length may add one letter and take one; of the next length, add one.
REACH = {1: (1, 1), 2: (1, 0)}


def damaged(run: str, checksum: int, every: int) -> str:
    """The run, or without one letter if ``every`` divides the checksum."""
    if checksum % every:
        return run
    place = checksum % len(run)
    return run[:place] + run[place + 1:]


def _counted(batches: Iterator[pa.RecordBatch], least: int, every: int | None) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[{LETTERS_OF_A_WORD}]{{{least},}}")
    counts, seen = {}, 0

    def flush():
        words = pa.array(list(counts), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), pc.ascii_lower(batch.column(1)).to_pylist()):
            if not text:
                continue
            start = zlib.crc32(f"{key}:".encode())
            for word, n in Counter(runs.findall(text)).items():
                if every:
                    word = damaged(word, zlib.crc32(word.encode(), start), every)
                    if len(word) < least:
                        continue
                counts[word] = counts.get(word, 0) + n
            seen += len(text)
            if len(counts) > HELD or seen > LETTERS:
                yield flush()
                counts, seen = {}, 0
    if counts:
        yield flush()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 5, least_count: int = 3,
               damage_every: int | None = None) -> DataFrame:
    """``(word, n)`` of the runs of letters, A-Z lower-cased, that are long and frequent enough.

    With ``damage_every``, a run loses a letter where that number divides the CRC-32 of ``<id>:<run>``.
    """
    rows = docs.select(F.coalesce(c(key).cast("string"), F.lit("")), c(text))
    found = rows.mapInArrow(lambda batches: _counted(batches, least_letters, damage_every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Count vectors: a to z, then the other code points by their last 6 bits."""
    plain = (codes >= 97) & (codes <= 122)
    place = np.where(plain, codes - 97, 26 + codes % 64)
    out = np.zeros((len(codes), DIMENSIONS), np.int16 if codes.shape[1] < 1 << 14 else np.int32)
    rows = np.arange(len(codes))
    for column in place.T:
        out[rows, column] += 1
    return out


class Tree:
    """A k-d tree: a node cuts the box it stands for at a value of one count; leaves hold rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, bucket: int):
        # Of each node: the count that is cut, the last value to the left, and the node's own bounds of that count.
        self.cut: list[tuple[int, int, int, int] | None] = []
        self.below: list[list[int]] = []
        self.rows: list[np.ndarray | None] = []
        width = vectors.shape[1]
        most = np.iinfo(vectors.dtype).max // 2
        stack = [(np.arange(len(vectors)), np.zeros(width, np.int64), np.full(width, most, np.int64), None)]
        while stack:
            rows, low, high, parent = stack.pop()
            number, own = len(self.cut), vectors[rows]
            if parent is not None:
                self.below[parent[0]][parent[1]] = number
            self.below.append([-1, -1])
            spread = own.var(axis=0) if len(rows) > bucket else np.zeros(1)
            dimension = int(spread.argmax())
            if not spread[dimension]:
                self.cut.append(None)
                self.rows.append(rows)
                continue
            at = int(np.floor(own[:, dimension].mean()))
            left = own[:, dimension] <= at
            self.cut.append((dimension, at, int(low[dimension]), int(high[dimension])))
            self.rows.append(None)
            under, over = high.copy(), low.copy()
            under[dimension], over[dimension] = at, at + 1
            stack.append((rows[left], low, under, (number, 0)))
            stack.append((rows[~left], over, high, (number, 1)))

    def reached(self, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the rows of ``vectors`` that adding ``up`` and taking ``down`` letters can bring into their boxes.

        The letters that a row lacks for a box, or has too many, are kept up to date by the one count that a cut changes.
        """
        nothing = np.zeros(len(vectors), np.int64)
        stack = [(0, np.arange(len(vectors)), nothing, nothing)]
        while stack:
            node, rows, lacking, beyond = stack.pop()
            if self.cut[node] is None:
                yield node, rows
                continue
            dimension, at, low, high = self.cut[node]
            own = vectors[rows, dimension].astype(np.int64)
            over = beyond - np.maximum(own - high, 0) + np.maximum(own - at, 0)
            under = lacking - np.maximum(low - own, 0) + np.maximum(at + 1 - own, 0)
            for below, near, lacks, exceeds in ((self.below[node][0], over <= down, lacking, over),
                                                (self.below[node][1], under <= up, under, beyond)):
                if near.any():
                    stack.append((below, rows[near], lacks[near], exceeds[near]))

    def pairs(self, own: np.ndarray, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ``vectors`` and of the tree's own whose counts differ by that little.

        The sum of all differences is ``up - down``, since that is the difference in length. So they are within
        reach exactly if their squares add up to at most ``up + down``, and those come from a product of matrices.
        """
        exact = np.float32 if own.sum(axis=1, dtype=np.int64).max(initial=0) < 2000 else np.float64
        own, vectors = own.astype(exact), vectors.astype(exact)
        own_squares, squares = (own * own).sum(axis=1), (vectors * vectors).sum(axis=1)
        for leaf, rows in self.reached(vectors, up, down):
            held = self.rows[leaf]
            step = max(1, NUMBERS // len(held))
            for some in (rows[i:i + step] for i in range(0, len(rows), step)):
                shared = vectors[some] @ own[held].T
                a, b = np.nonzero(2 * shared >= squares[some][:, None] + (own_squares[held] - (up + down))[None, :])
                if len(a):
                    yield some[a], held[b]


def one_edit(short: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replacement (equal lengths) or by one more letter in ``other``."""
    length = short.shape[1]
    if other.shape[1] == length:
        return (short != other).sum(axis=1) == 1
    front = np.logical_and.accumulate(short == other[:, :length], axis=1).sum(axis=1)
    back = np.logical_and.accumulate(short[:, ::-1] == other[:, :0:-1], axis=1).sum(axis=1)
    return front + back >= length


def _routed(batches: Iterator[pa.RecordBatch], trees: dict[int, Tree]) -> Iterator[pa.RecordBatch]:
    """A row per word for its cell, and one for every cell in which it is searched."""
    for batch in batches:
        words, n = batch.column(0), batch.column(1)
        lengths = np.asarray(pc.utf8_length(words)).astype(np.int64)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            vectors = None
            if length in trees or length + 1 in trees:
                vectors = letter_counts(letters(words.take(pa.array(at)).to_pylist(), length))
            for kind, target, (up, down) in ((0, length, (0, 0)), (1, length, REACH[1]), (2, length + 1, REACH[2])):
                cells = trees[target].reached(vectors, up, down) if target in trees else [(0, np.arange(len(at)))]
                for cell, rows in cells:
                    take = pa.array(at[rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), x, np.int32)) for x in (target, cell, kind)]
                        + [words.take(take), n.take(take)], ["length", "cell", "kind", "word", "n"])


class _Cell:
    """The words of one cell, in a tree once the first search arrives."""

    def __init__(self):
        self.parts, self.tree = [], None

    def search(self, words: pa.Array, n: pa.Array, kind: int, length: int) -> Iterator[list[pa.Array]]:
        """Near pairs ``(word, near, count of near)``; from a shorter word, in both directions."""
        if not self.parts:
            return
        if self.tree is None:
            self.words, self.n = (pa.concat_arrays([part[i] for part in self.parts]) for i in range(2))
            self.letters = letters(self.words.to_pylist(), length)
            self.vectors = letter_counts(self.letters)
            self.tree = Tree(self.vectors, BUCKET)
        asked = letters(words.to_pylist(), length - (kind == 2))
        some, held, waiting = [], [], 0
        for a, b in chain(self.tree.pairs(self.vectors, letter_counts(asked), *REACH[kind]), [(None, None)]):
            if a is not None:
                some.append(a)
                held.append(b)
                waiting += len(a)
            if waiting and (a is None or waiting * length > NUMBERS):
                x, y = self._verified(asked, np.concatenate(some), np.concatenate(held), max(1, NUMBERS // length))
                some, held, waiting = [], [], 0
                x, y = pa.array(x), pa.array(y)
                yield [words.take(x), self.words.take(y), self.n.take(y)]
                if kind == 2:
                    yield [self.words.take(y), words.take(x), n.take(x)]

    def _verified(self, asked: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        near = [one_edit(asked[a[i:i + step]], self.letters[b[i:i + step]]) for i in range(0, len(a), step)]
        near = np.concatenate(near)
        return a[near], b[near]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs from the rows of cells, each cell's words before its searches."""
    key, cell = None, _Cell()
    for batch in batches:
        marks = np.column_stack([np.asarray(batch.column(i)) for i in range(5)])
        starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)]) if len(marks) else []
        for start, end in zip(starts, [*starts[1:], len(marks)]):
            length, kind = int(marks[start][0]), int(marks[start][4])
            if key != tuple(marks[start][:4]):
                key, cell = tuple(marks[start][:4]), _Cell()
            words, n = (batch.column(i).slice(start, end - start) for i in (5, 6))
            if kind == 0:
                cell.parts.append((words, n))
                continue
            step = max(1, NUMBERS // max(length, DIMENSIONS))
            for i in range(0, len(words), step):
                for found in cell.search(words.slice(i, step), n.slice(i, step), kind, length):
                    yield pa.RecordBatch.from_arrays(found, ["word", "near", "near_n"])


def cell_trees(words: DataFrame) -> dict[int, Tree]:
    """A tree of cells for each length of more than ``LEAF`` words."""
    sized = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > LEAF)
    sizes = {r["length"]: r["count"] for r in sized.collect()}
    if not sizes:
        return {}
    share = -(-sum(sizes.values()) // SAMPLE)
    sample = words.where(F.length("word").isin(list(sizes)) & (F.pmod(F.xxhash64("word"), F.lit(share)) == 0))
    by_length = defaultdict(list)
    for row in sample.select("word").toLocalIterator():
        by_length[len(row["word"])].append(row["word"])
    return {length: Tree(letter_counts(letters(own, length)), max(16, LEAF // share))
            for length, own in by_length.items()}


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: all ordered pairs of distinct words ``(word, n)`` that are one edit apart."""
    spark = words.sparkSession
    trees = spark.sparkContext.broadcast(cell_trees(words))
    routed = materialize(words.select("word", "n").mapInArrow(
        lambda batches: _routed(batches, trees.value), "length int, cell int, kind int, word string, n long"), "searches")
    held = F.col("kind") == 0
    cells = routed.groupBy("length", "cell").agg(
        F.greatest(F.ceil(F.count_if(held) / LEAF), F.ceil(F.sum(F.when(held, F.col("length"))) / CELL_LETTERS)).cast("int").alias("pieces"),
        F.ceil(F.count_if(~held) / SEARCHES).cast("int").alias("chunks"))
    # At most one row for every LEAF words or SEARCHES searches.
    large = cells.where("pieces > 1 or chunks > 1")
    dealt = routed.join(F.broadcast(large), ["length", "cell"], "left")
    number = F.xxhash64("word")

    def share(count, fixed):
        """One number by hash for the rows that are dealt out, all numbers for those they meet."""
        count = F.coalesce(count, F.lit(1))
        return F.when(fixed, F.array(F.pmod(number, count).cast("int"))).otherwise(F.sequence(F.lit(0), (count - 1).cast("int")))

    dealt = (dealt.withColumn("piece", F.explode(share(F.greatest("pieces", F.lit(1)), held)))
             .withColumn("chunk", F.explode(share(F.greatest("chunks", F.lit(1)), ~held))))
    cell = ["length", "cell", "piece", "chunk"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.select(*cell, "kind", "word", "n").repartition(tasks, *cell).sortWithinPartitions(*cell, "kind")
    return sorted_rows.mapInArrow(_searched, "word string, near string, near_n long")


def forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """``(word, n, form, form_n, n_near)``; the form is the most frequent near word, if ``factor`` times as frequent."""
    nothing = F.lit(None)
    rows = words.select("word", "n", nothing.cast("string").alias("near"), nothing.cast("long").alias("near_n")).unionByName(
        near_pairs(words).select("word", nothing.cast("long").alias("n"), "near", "near_n"))
    first = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("first")
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), first)
    taken = -F.col("first.less") >= factor * F.col("n")
    return found.select("word", "n", F.when(taken, F.col("first.near")).alias("form"),
                        F.when(taken, -F.col("first.less")).alias("form_n"), "n_near")


def roots(found: DataFrame) -> DataFrame:
    """``(word, root)`` of the words with a form: what following forms ends at.

    Every round doubles the steps taken. A word whose target has no form is done and is not joined again.
    """
    links = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    further = links.select(F.col("word").alias("root"), F.lit(True).alias("open"))
    steps = materialize(links.join(further, "root", "left").select("word", "root", F.coalesce("open", F.lit(False)).alias("open")), "steps")
    while not steps.where("open").isEmpty():
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("open").alias("still"))
        moved = steps.where("open").join(after, "root").select("word", F.col("next").alias("root"), F.col("still").alias("open"))
        steps = materialize(steps.where("not open").unionByName(moved), "steps")
    return steps.select("word", "root")


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all ``words`` (``word``, ``n``, no word twice)."""
    found = materialize(forms(words, factor), "forms")
    joined = found.join(roots(found), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", damage_every: int | None = None) -> DataFrame:
    """The variants among the words of ``docs``."""
    return variants(materialize(vocabulary(docs, key, text, damage_every=damage_every), "words"))
