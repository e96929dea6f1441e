"""Words and lines of whole Arrow columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  Its hash depends on its bytes alone, never
on where it stands or how texts are batched, so that hashes of different tasks may be compared and stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_U64 = np.uint64
#: Longer segments are hashed one by one.
_LANES_BYTES = 128
#: Texts handled at once, in bytes; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All of ASCII but letters and digits, for words without punctuation.
MARKS = np.ones(256, dtype=bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_STEP = _U64(0x9E3779B97F4A7C15)
#: The bytes of a lane of eight that belong to a segment of which so many are left.
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], _U64)


@dataclass(frozen=True)
class Texts:
    """UTF-8 texts that lie one behind the other: text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def from_arrow(column: pa.Array) -> Texts:
    """The texts of a string or binary column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first = int(bounds[0])
    size = int(bounds[-1]) - first
    flat = np.frombuffer(data, np.uint8, size, first) if size else np.zeros(0, np.uint8)
    return Texts(flat, bounds - first)


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch of about ``size`` bytes of text, each with its texts; one longer text is a part of its own."""
    texts = from_arrow(batch.column(text))
    at, count = 0, len(texts)
    while at < count:
        end = int(np.searchsorted(texts.offsets, texts.offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), count)
        begin, stop = texts.offsets[at], texts.offsets[end]
        yield batch.slice(at, end - at), Texts(texts.data[begin:stop], texts.offsets[at : end + 1] - begin)
        at = end


def words(texts: Texts, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text where its words begin in these."""
    inside = ~between[texts.data]
    size = len(inside)
    before = np.zeros(size + 1, bool)
    before[1:] = inside
    before[texts.offsets] = False  # no word reaches into the next text
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(size + 1, bool)
    after[:-1] = inside
    after[texts.offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, texts.offsets)


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every ``\\n``-split line, and for each text where its lines begin in these."""
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]), kind="stable")
    bounds = np.arange(len(texts.offsets)) + np.searchsorted(breaks, texts.offsets)
    return starts, ends, bounds


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of every segment; ``fold`` takes A-Z as a-z.

    Eight bytes at a time go through a bijection, which starts from the length, so segments of up to eight bytes never
    collide and longer ones no more than by chance.
    """
    sizes = ends - starts
    flat = np.zeros(len(data) + 8, np.uint8)
    flat[: len(data)] = _LOWER[data] if fold else data
    lanes = np.ndarray((len(data) + 1,), "<u8", flat, strides=(1,))
    out = mix(sizes.astype(_U64) + _STEP)
    long = sizes > _LANES_BYTES
    going = np.flatnonzero((sizes > 0) & ~long)
    for at in range(0, _LANES_BYTES, 8):
        rest = sizes[going] - at
        out[going] = mix((out[going] ^ lanes[starts[going] + at] & _LANE[np.minimum(rest, 8)]) * _STEP)
        going = going[rest > 8]
        if not len(going):
            break
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh64_intdigest(flat[starts[i] : ends[i]].tobytes())
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; a sort of numbers is far faster than the table that ``np.unique`` builds."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def window_starts(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First key of every run of ``n`` keys within a text, and for each text where its runs begin in these."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    where = np.concatenate([[0], np.cumsum(counts)])
    return np.repeat(bounds[:-1] - where[:-1], counts) + np.arange(where[-1]), where


def windows(keys: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` keys within a text, and for each text where its runs begin in these."""
    starts, where = window_starts(bounds, n)
    if not len(starts):
        return np.zeros(0, _U64), where
    rolled = np.zeros(len(keys) - n + 1, _U64)
    for k in range(n):
        rolled = mix(rolled * _U64(0x9E3779B97F4A7C15) + keys[k : len(keys) - n + 1 + k])
    return rolled[starts], where


def per_text(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Keys that are equal only where they stand in the same text."""
    salt = mix(np.arange(1, len(bounds), dtype=_U64))
    return mix(keys ^ np.repeat(salt, np.diff(bounds)))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between each two bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
