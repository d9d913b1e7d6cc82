"""Word and shingle hashes of whole Arrow batches, computed on their byte buffers.

A word is a run of bytes that a 256-entry class table does not call a separator. Its
hash is a polynomial over its bytes modulo 2**64, taken from one running sum over the
buffer, and mixed. No Python object is made per word. Distinct words or shingles collide
with probability about 2**-64 a pair.

Texts are read in segments of about ``SEGMENT`` bytes that end at separators, so the
memory besides the batch and the hashes is bounded unless a single word is longer than that.
Operators that need several arrays a word read a batch in ``slices``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc

SEGMENT = 1 << 18
#: Texts, and bytes of them, of a batch whose arrays exist together; a longer text stands alone.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 500, 1 << 22
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def byte_table(separators: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``(is_separator, value)`` per byte; ``lower`` folds A-Z."""
    is_separator = np.zeros(256, bool)
    is_separator[list(separators)] = True
    values = BYTE_VALUES.copy()
    if lower:
        values[65:91] = values[97:123]
    return is_separator, values


#: Blanks that part words, and all ASCII that is neither letter nor digit.
BLANKS = b" \t\n\x0b\x0c\r"
NOT_ALNUM = bytes(i for i in range(128) if not chr(i).isalnum())
PLAIN = byte_table(BLANKS)
ALNUM = byte_table(NOT_ALNUM)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string array; a null counts as an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Some hundred rows at a time, fewer if their texts in ``column`` are long."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(batch):
        before = ends[begin - 1] if begin else 0
        end = int(np.searchsorted(ends, before + BYTES_AT_ONCE, "right"))
        end = min(max(end, begin + 1), begin + TEXTS_AT_ONCE, len(batch))
        yield batch.slice(begin, end - begin)
        begin = end


def _segments(separator: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer that lie on a separator or between two texts."""
    begin, total = 0, len(separator)
    while begin < total:
        end = min(begin + size, total)
        while end < total:
            stop = min(end + size, total)
            blank = np.flatnonzero(separator[end:stop])
            border = ends[np.searchsorted(ends, end)]
            near = min(border, end + blank[0] if len(blank) else total)
            if near <= stop:
                end = near
                break
            end = stop
        yield begin, end
        begin = end


def word_hashes(texts: pa.Array, table=PLAIN, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: text ``i`` has the words ``hashes[first[i]:first[i + 1]]``."""
    data, offsets = buffers(texts)
    is_separator, values = table
    separator = is_separator[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    found, begun = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    span = min(len(data), size)
    power, inverse = _powers(span, BASE), _powers(span, INVERSE)
    for a, b in _segments(separator, offsets[1:], size):
        word = ~separator[a:b]
        cut = border[a:b]
        before = np.concatenate(([False], word[:-1]))
        start = np.flatnonzero(word & (~before | cut))
        if not len(start):
            continue
        after = np.concatenate((word[1:] & ~cut[1:], [False]))
        end = np.flatnonzero(word & ~after) + 1
        if b - a > len(power):
            power, inverse = _powers(b - a, BASE), _powers(b - a, INVERSE)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data[a:b]] * power[:b - a])))
        found.append(mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)))
        begun.append(start + a)
    hashes, starts = np.concatenate(found), np.concatenate(begun)
    return hashes, np.searchsorted(starts, offsets)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours; runs may cross texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, width):
        out = out * STEP + hashes[i:i + n]
    return mix(out)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text, the hashes of its ``width``-word runs in order.

    A text with fewer words has one, of its whole sequence; one without words has none.
    """
    runs = windows(hashes, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield runs[a:b - width + 1]
        elif b > a:
            yield mix(windows(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield runs[:0]
