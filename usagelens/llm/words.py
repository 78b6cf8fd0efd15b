"""Words of many texts at once, as numpy arrays over one UTF-8 buffer.

A word is a run of bytes other than space and tab to carriage return, the same in every operator.
Work is done a few megabytes at a time, so memory is bounded by the piece, or by one long text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_PIECE = 1 << 22


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, nulls as empty, and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes each, or one row where it alone has more."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it."""
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_lists(text: bytes, most: int = _PIECE) -> Iterator[list[bytes]]:
    """The words of one text in lists, each of about ``most`` bytes of it."""
    at = 0
    while at < len(text):
        end = min(at + most, len(text))
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, np.ndarray] = {}
_REACH = 1 << 18


def _table(base: int, count: int) -> np.ndarray:
    """Powers of ``base``. Of each base one table is kept, of at most 4 MB."""
    if count > 2 * _REACH:
        return _powers(base, count)
    if base not in _tables or len(_tables[base]) < count:
        _tables[base] = _powers(base, 1 << max(12, (count - 1).bit_length()))
    return _tables[base][:count]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A polynomial hash, modulo 2**64, of each range of ``values``; both ends must ascend."""
    out, inverse, at = np.empty(len(starts), np.uint64), pow(base, -1, 1 << 64), 0
    while at < len(starts):
        low = starts[at]
        stop = int(np.searchsorted(starts, low + _REACH, "left"))
        part = values[low : ends[stop - 1]].astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _table(base, len(part)), out=total[1:])
        first, last = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (total[last] - total[first]) * _table(inverse, len(part) + 1)[first]
        at = stop
    return mix(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0):
    """A 64-bit hash of each word; ``which`` chooses one of two independent ones."""
    return _ranges(data, starts, ends, _BASES[which])


def window_hashes(words: np.ndarray, first: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each index in ``first``."""
    return _ranges(words, first, first + size, _BASES[which] ^ 0xABCDEF0123456788)


def window_starts(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all words that begin ``size`` words of their row, and their place in the row."""
    count = np.maximum(np.diff(bounds) - size + 1, 0)
    total = np.cumsum(count)
    place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
    return np.repeat(bounds[:-1], count) + place, place
