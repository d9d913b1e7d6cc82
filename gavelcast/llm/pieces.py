"""Best and N-best segmentations of texts over a SentencePiece vocabulary, and back.

The lattice of a text has an edge for each vocabulary piece that matches at a place, with the
piece's score from the model file; characters without a piece get one edge of byte pieces,
``UNKNOWN`` below the lowest score. No piece has a blank mark behind another character, so
the lattice falls apart into pre-tokens (a run of marks with the characters behind it):

* A forward pass gives the best score up to every place of every distinct pre-token of a batch
  at once (``Lattices``, array code along places). Its back pointers give the best segmentation.
* A backward pass gives the best score behind every place, and by both the gap between the best
  and the second best segmentation of each pre-token.
* A text's N best segmentations can only differ from the best in its N-1 pre-tokens of smallest
  gap. Those alone are searched: A-star from the end to the start, with the forward scores as
  heuristic. They are exact, so a path is final when it is first taken from the queue.

Order among equal scores: compare the pieces from the end of a pre-token, longer piece first.

Defined cases: a null or empty text has no pieces and decodes to "". A U+2581 in a text decodes as a blank,
as in the library. Repeated rows are encoded each; result columns replace input columns of the same names.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from ..functions.columns import c
from .links import lists
from .tokens import mix

MARK = "▁"
UNKNOWN = 10.0
#: Characters of new pre-tokens that are segmented at once, and pre-tokens a task keeps.
AT_ONCE = 1 << 15
KEPT = 600_000
LOWEST = -1e300


class Vocabulary:
    """Pieces as a trie whose edges lie in one hash table, so many places step at once."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        self.text = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(size):
            if library.is_byte(i):
                self.byte_ids[int(self.text[i][3:5], 16)] = i
        self.first_byte = int(self.byte_ids.min())
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        pieces = [i for i in range(size) if not special[i]]
        if any(MARK in self.text[i].lstrip(MARK) for i in pieces):
            raise ValueError("a piece continues behind a blank, so pre-tokens do not encode alone")
        self.score = np.array([library.get_score(i) for i in range(size)])
        # The library gives runs of blanks a score that only bars merges; they rank as the
        # lowest ordinary piece here.
        ordinary = self.score[pieces]
        floor = ordinary[ordinary > -1e8].min()
        self.score[self.score <= -1e8] = floor
        self.unknown = floor - UNKNOWN
        self.known = {self.text[i]: (i, float(self.score[i])) for i in pieces}
        # What a piece adds to a text; a byte from 128 on is only a part of a character.
        self.plain = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else piece for i, piece in enumerate(self.text)]
        self.wide = np.array([self.byte_of.get(i, 0) > 127 for i in range(size)])
        edges: dict[tuple[int, int], int] = {}
        piece_of = [-1]
        self.longest = 0
        for i in pieces:
            at = 0
            self.longest = max(self.longest, len(self.text[i]))
            for ch in self.text[i]:
                at = edges.setdefault((at, ord(ch)), len(piece_of))
                if at == len(piece_of):
                    piece_of.append(-1)
            piece_of[at] = i
        self.piece_of = np.array(piece_of)
        keys = np.array([(a << 21) | ch for a, ch in edges], np.int64)
        targets = np.array(list(edges.values()), np.int64)
        self.bits = 64 - (int(len(keys)).bit_length() + 4)
        self.keys = np.full(1 << (64 - self.bits), -1, np.int64)
        self.targets = np.zeros(len(self.keys), np.int64)
        self.probes, rest = 0, np.arange(len(keys))
        slot = self._slot(keys)
        while len(rest):
            self.probes += 1
            free = self.keys[slot[rest]] < 0
            taken = rest[free]
            _, one = np.unique(slot[taken], return_index=True)
            put = taken[one]
            self.keys[slot[put]], self.targets[slot[put]] = keys[put], targets[put]
            rest = np.setdiff1d(rest, put, assume_unique=True)
            slot[rest] = (slot[rest] + 1) % len(self.keys)

    def spelled(self, ids: Iterable[int]) -> list[int]:
        """Ids with the characters that have no piece (as ``-1 - code point``) spelled in bytes."""
        out = []
        for i in ids:
            out += [i] if i >= 0 else self.byte_ids[list(chr(-1 - i).encode("utf-8", "surrogatepass"))].tolist()
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(self.bits)).astype(np.int64)

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Next state of each, or -1."""
        keys = (states << 21) | chars
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            seen = self.keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.targets[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % len(self.keys)
        return out


class Lattices:
    """The lattices of many pre-tokens, laid end to end in one line of places."""

    def __init__(self, vocabulary: Vocabulary, parts: list[str]):
        self.vocabulary = vocabulary
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(lengths)
        # Place x of a part lies at its offset + x; a part of n characters has n + 1 places.
        self.lengths, self.offset = lengths, ends - lengths + np.arange(len(parts))
        of_char = np.repeat(np.arange(len(parts)), lengths)
        place = np.arange(len(chars)) + of_char
        left = ends[of_char] - np.arange(len(chars))
        found = self._edges(chars, place, left)
        self.starts, self.stops, self.ids = found
        self.weights = np.where(self.ids >= 0, vocabulary.score[np.maximum(self.ids, 0)], vocabulary.unknown)
        n = len(chars) + len(parts)
        self.part_of = np.repeat(np.arange(len(parts)), lengths + 1)
        self.depth = np.arange(n) - self.offset[self.part_of]
        self._forward(n)

    def _edges(self, chars, place, left):
        starts, stops, ids = [], [], []
        alive, states = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        covered = np.zeros(len(chars), bool)
        for k in range(self.vocabulary.longest):
            keep = left[alive] > k
            alive, states = alive[keep], states[keep]
            states = self.vocabulary.step(states, chars[alive + k])
            alive, states = alive[states >= 0], states[states >= 0]
            if not len(alive):
                break
            piece = self.vocabulary.piece_of[states]
            whole = piece >= 0
            starts.append(place[alive[whole]])
            stops.append(place[alive[whole]] + k + 1)
            ids.append(piece[whole])
            if k == 0:
                covered[alive[whole]] = True
        odd = np.flatnonzero(~covered)
        starts.append(place[odd])
        stops.append(place[odd] + 1)
        ids.append(-1 - chars[odd])
        # Longer pieces first, so a stable sort by the end leaves those that start first in front.
        return tuple(np.concatenate(x[::-1]) for x in (starts, stops, ids))

    def _forward(self, n: int) -> None:
        order = np.argsort(self.depth[self.stops] * n + self.stops, kind="stable")
        self.starts, self.stops = self.starts[order], self.stops[order]
        self.ids, self.weights = self.ids[order], self.weights[order]
        self.forward, self.last = np.full(n, LOWEST), np.full(n, -1)
        self.forward[self.depth == 0] = 0
        depth = self.depth[self.stops]
        cuts = np.searchsorted(depth, np.arange(1, (depth[-1] if len(depth) else 0) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            through = self.forward[self.starts[a:b]] + self.weights[a:b]
            stops = self.stops[a:b]
            first = np.flatnonzero(np.concatenate(([True], stops[1:] != stops[:-1])))
            best = np.maximum.reduceat(through, first)
            size = np.diff(np.append(first, b - a))
            hit = np.flatnonzero(through == np.repeat(best, size))
            # Of equal edges the one that starts first, which has the longest piece.
            group = np.repeat(np.arange(len(first)), size)[hit]
            one = hit[np.concatenate(([True], group[1:] != group[:-1]))]
            self.forward[stops[first]] = best
            self.last[stops[first]] = a + one
        self.edge_cuts = cuts

    def gaps(self) -> np.ndarray:
        """Per part, how far the second best segmentation lies below the best (inf: there is none)."""
        n = len(self.forward)
        behind = np.full(n, LOWEST)
        end = self.offset + self.lengths
        behind[end] = 0
        order = np.argsort(self.starts - self.depth[self.starts] * n, kind="stable")
        starts, stops, weights = self.starts[order], self.stops[order], self.weights[order]
        depth = -self.depth[starts]
        cuts = np.searchsorted(depth, np.arange(depth[0], 2)) if len(depth) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            through = behind[stops[a:b]] + weights[a:b]
            at = starts[a:b]
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            behind[at[first]] = np.maximum.reduceat(through, first)
        on_best = np.zeros(len(self.starts), bool)
        for _, edges in self._walk():
            on_best[edges] = True
        part = self.part_of[self.starts]
        through = np.where(on_best, LOWEST, self.forward[self.starts] + self.weights + behind[self.stops])
        second = np.full(len(self.lengths), LOWEST)
        np.maximum.at(second, part, through)
        return np.where(second > LOWEST / 2, self.forward[end] - second, np.inf)

    def _walk(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From the ends of all parts along the best edges: ``(parts, edges)`` a step."""
        parts = np.flatnonzero(self.lengths > 0)
        at = (self.offset + self.lengths)[parts]
        while len(parts):
            edges = self.last[at]
            yield parts, edges
            at = self.starts[edges]
            more = self.depth[at] > 0
            parts, at = parts[more], at[more]

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the best segmentation of all parts, end to end, and how many each has."""
        parts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for who, edges in self._walk():
            parts.append(who)
            ids.append(self.ids[edges])
        step = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        parts, ids = np.concatenate(parts), np.concatenate(ids)
        order = np.lexsort((-step, parts))
        parts, ids = parts[order], ids[order]
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            bytes_of = [self.vocabulary.spelled([i]) for i in ids[odd].tolist()]
            size = np.ones(len(ids), np.int64)
            size[odd] = [len(x) for x in bytes_of]
            parts, at = np.repeat(parts, size), np.cumsum(size) - size
            ids = np.repeat(ids, size)
            for i, spelled in zip(at[odd].tolist(), bytes_of):
                ids[i:i + len(spelled)] = spelled
        return ids.astype(np.int32), np.bincount(parts, minlength=len(self.lengths))


def n_best(vocabulary: Vocabulary, part: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations of a pre-token: (score, ids), best first.

    Viterbi scores of all prefixes are the heuristic of a search from the end to the start. They are what
    the rest of a path can reach at best and does reach, so paths leave the queue in their final order.
    """
    known, longest, size = vocabulary.known, vocabulary.longest, len(part)
    into: list[list] = [[]]
    forward = [0.0] + [LOWEST] * size
    for end in range(1, size + 1):
        edges = []
        for start in range(max(0, end - longest), end):
            piece = known.get(part[start:end])
            if piece:
                edges.append((start, piece[0], piece[1]))
        if not edges or edges[-1][0] < end - 1:
            # Only a character that is no piece itself is spelled in bytes.
            edges.append((end - 1, -1 - ord(part[end - 1]), vocabulary.unknown))
        forward[end] = max(forward[start] + weight for start, _, weight in edges)
        into.append(edges)
    queue = [(-forward[size], (size,), (), 0.0)]
    found = []
    while queue and len(found) < n:
        _, path, ids, score = heapq.heappop(queue)
        if path[-1] == 0:
            found.append((score, vocabulary.spelled(ids[::-1])))
            continue
        for start, piece, weight in into[path[-1]]:
            gained = score + weight
            heapq.heappush(queue, (-(gained + forward[start]), (*path, start), (*ids, piece), gained))
    return found


class Encoder:
    """Segmentations of texts, with those of their pre-tokens kept between texts."""

    def __init__(self, model: bytes, n: int, at_once: int = AT_ONCE, kept: int = KEPT):
        self.vocabulary, self.n, self.at_once, self.kept = Vocabulary(model), n, at_once, kept
        feed = "" if any("\n" in piece for piece in self.vocabulary.text) else "\n"
        self.parts = re.compile(f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+" + ("|\n" if feed else "")).findall
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.scores, self.gap = np.zeros(0), np.zeros(0)
        self.others: dict[str, list] = {}

    def split(self, text: str | None) -> list[str]:
        return self.parts(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, parts: Iterable[str]) -> None:
        """Segment the pre-tokens not known yet, some ``at_once`` characters at a time."""
        batch, size = [], 0
        for part in [part for part in dict.fromkeys(parts) if part not in self.index]:
            self.index[part] = len(self.index)
            batch.append(part)
            size += len(part)
            if size >= self.at_once:
                self._segment(batch)
                batch, size = [], 0
        if batch:
            self._segment(batch)

    def _segment(self, parts: list[str]) -> None:
        lattices = Lattices(self.vocabulary, parts)
        ids, sizes = lattices.best()
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, ids))
        self.scores = np.concatenate((self.scores, lattices.forward[lattices.offset + lattices.lengths]))
        if self.n > 1:
            self.gap = np.concatenate((self.gap, lattices.gaps()))

    def encode(self, texts: list[str | None], others: bool = True
               ) -> Iterator[tuple[np.ndarray, list[float], list[np.ndarray]]]:
        """Per text: ids of the best segmentation, scores of the N best, ids of the others if wanted."""
        done = 0
        while done < len(texts):
            if len(self.index) > self.kept:
                self._clear()
            parts, size, upto = [], 0, done
            while upto < len(texts) and size < 8 * self.at_once:
                parts.append(self.split(texts[upto]))
                size += len(texts[upto] or "")
                upto += 1
            self.learn(chain.from_iterable(parts))
            for own in parts:
                yield self._text(own, others)
            done = upto

    def _best(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentation, and where those of each pre-token end."""
        begin = self.first[at]
        size = self.first[at + 1] - begin
        ends = np.cumsum(size)
        shift = np.repeat(begin - (ends - size), size)
        return self.ids[shift + np.arange(len(shift))], ends

    def _text(self, parts: list[str], with_others: bool):
        if not parts:
            return np.zeros(0, np.int32), [], []
        at = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        (ids, ends), score = self._best(at), float(self.scores[at].sum())
        if self.n == 1:
            return ids, [score], []
        gaps = self.gap[at]
        loose = np.argsort(gaps, kind="stable")[:self.n - 1] if len(at) < 4 * self.n else np.array(
            heapq.nsmallest(self.n - 1, np.argpartition(gaps, self.n)[:self.n].tolist(), key=lambda i: (gaps[i], i)))
        loose = sorted(i for i in loose.tolist() if gaps[i] < np.inf)
        # What choices in the loose pre-tokens lose against the best, smallest loss first.
        choices = [(0.0, ())]
        for i in loose:
            options = self._options(parts[i])
            top = options[0][0]
            choices = sorted((lost + top - gained, (*picks, k)) for lost, picks in choices
                             for k, (gained, _) in enumerate(options))[:self.n]
        others = []
        for _, picks in choices[1:] if with_others else []:
            rest, own = 0, []
            for i, k in zip(loose, picks):
                own += [ids[rest:ends[i - 1] if i else 0], self._options(parts[i])[k][1]]
                rest = ends[i]
            others.append(np.concatenate([*own, ids[rest:]]))
        return ids, [score - lost for lost, _ in choices], others

    def _options(self, part: str) -> list:
        if part not in self.others:
            self.others[part] = [(score, np.array(ids, np.int32)) for score, ids in n_best(self.vocabulary, part, self.n)]
        return self.others[part]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of pieces; runs of byte pieces are read as UTF-8."""
    ids = np.asarray(ids, np.int64)
    if not vocabulary.wide[ids].any():
        return "".join(map(vocabulary.plain.__getitem__, ids.tolist())).removeprefix(MARK).replace(MARK, " ")
    out, raw = [], bytearray()
    for i in ids.tolist():
        byte = vocabulary.byte_of.get(i)
        if byte is not None:
            raw.append(byte)
            continue
        if raw:
            out.append(raw.decode("utf-8", "replace"))
            raw = bytearray()
        out.append(vocabulary.text[i])
    out.append(raw.decode("utf-8", "replace"))
    return "".join(out).removeprefix(MARK).replace(MARK, " ")


def encoded(docs: DataFrame, model_path: str, text: str = "text", n: int = 3, keep_others: bool = False) -> DataFrame:
    """Adds ``ids`` (best segmentation), ``n_pieces``, ``scores`` (of the ``n`` best) and ``round_trip``
    (whether decoding gives the text back); with ``keep_others`` also ``others``, the ids of the rest of the N best.
    """
    model = Path(model_path).read_bytes()
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
             T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("round_trip", T.BooleanType())]
    if keep_others:
        added.append(T.StructField("others", T.ArrayType(T.ArrayType(T.IntegerType()))))
    names = {field.name for field in added}
    kept = [name for name in docs.columns if name not in names]
    position, wanted = docs.columns.index(text), [docs.columns.index(name) for name in kept]
    schema = T.StructType([*[docs.schema[name] for name in kept], *added])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, n)
        for batch in batches:
            for begin in range(0, len(batch), 512):
                rows = batch.slice(begin, 512)
                texts = rows.column(position).to_pylist()
                ids, sizes, scores, same, others = [], [], [], [], []
                for body, (best, n_scores, rest) in zip(texts, encoder.encode(texts, keep_others)):
                    ids.append(best)
                    sizes.append(len(best))
                    scores.append(n_scores)
                    same.append(decode(encoder.vocabulary, best) == (body or "").replace(MARK, " "))
                    others.append(rest)
                columns = [lists(ids, np.int32), pa.array(sizes, pa.int64()),
                           pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_())]
                if keep_others:
                    first = np.concatenate(([0], np.cumsum([len(rest) for rest in others])))
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(first, pa.int32()), lists(chain.from_iterable(others), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(i) for i in wanted], *columns], names=[*kept, *[f.name for f in added]])

    return docs.select(*[c(name) for name in docs.columns]).mapInArrow(run, schema)
