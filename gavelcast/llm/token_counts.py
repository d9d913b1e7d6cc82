"""Token counts of whole texts under a SentencePiece BPE model, mostly without merging.

No piece of a usable vocabulary has a blank mark after another character. No merge can
then cross the border before a run of blank marks, so a text encodes piece by piece: every
run of marks with the characters behind it (a pre-token) encodes alone. The same holds around a
line feed where no piece contains one. ``Shortcut`` proves both from the vocabulary, once,
and finds the vocabulary strings that encode as a single token; those pre-tokens count one.
Only the others are merged by the library, once each while they stay in the task's cache.

Defined cases: a null or empty text has no tokens. U+2581 in a text is a blank, as in the
library. Control strings such as ``<s>`` in a text are ordinary characters. Rows are
counted each, so repeated rows repeat their result. Result columns replace input columns of
the same names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import c

MARK = "▁"
#: Pre-tokens a task keeps the counts of; beyond it the cache starts again.
CACHED = 400_000


class Shortcut(dict):
    """Counts by pre-token; a missing one is merged by the library and kept for a while."""

    def __init__(self, model: bytes, cached: int = CACHED):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        usable = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())
                  if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        if any(MARK in piece.lstrip(MARK) for piece in usable):
            raise ValueError("a piece continues behind a blank, so pre-tokens do not encode alone")
        line_feed = "\n" if not any("\n" in piece for piece in usable) else ""
        self.parts = re.compile(
            f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if line_feed else f"{MARK}+[^{MARK}]*").findall
        # Text behind a line feed has no mark; the feed keeps the library from adding one.
        self.feed = len(self.model.encode("\n"))
        starts = [piece for piece in usable if piece.startswith(MARK)]
        texts = [piece[1:].replace(MARK, " ") for piece in starts]
        self.single = {piece: 1 for piece, ids in zip(starts, self.model.encode(texts, num_threads=1))
                       if len(ids) == 1}
        # An encoding must be the identity on the text for the split to be the library's.
        if self.model.normalize("ﬁ Ａ  a ") != f"{MARK}ﬁ{MARK}Ａ{MARK}{MARK}a{MARK}":
            raise ValueError("the model rewrites texts before it splits them")
        self.cached = cached
        self.update(self.single)
        if line_feed:
            self["\n"] = self.feed - 1

    def __missing__(self, part: str) -> int:
        if part[0] == MARK:
            count = len(self.model.encode(part[1:].replace(MARK, " ")) if len(part) > 1
                        else self.model.encode("\n")) - (len(part) == 1) * (self.feed - 1)
        else:
            count = len(self.model.encode("\n" + part)) - self.feed
        if len(self) > self.cached:
            feed = self.get("\n")
            self.clear()
            self.update(self.single)
            if feed is not None:
                self["\n"] = feed
        self[part] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.parts(MARK + text.replace(" ", MARK))))


def counted(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    The model file is read by the driver and travels with the function.
    """
    model = Path(model_path).read_bytes()
    kept = [name for name in docs.columns if name not in ("n_bytes", "n_tokens", "over_limit")]
    position = docs.columns.index(text)
    wanted = [docs.columns.index(name) for name in kept]
    schema = T.StructType([*[docs.schema[name] for name in kept], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortcut = Shortcut(model)
        for batch in batches:
            counts = [shortcut.count(value.as_py()) for value in batch.column(position)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in wanted], pa.array(counts, pa.int64())], names=[*kept, "n_tokens"])

    done = docs.mapInArrow(run, schema)
    if text not in kept:
        raise ValueError(f"{text} has the name of a result column")
    return done.select(
        *[c(name) for name in kept],
        F.coalesce(F.octet_length(c(text)), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
