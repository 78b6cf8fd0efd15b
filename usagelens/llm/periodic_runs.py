"""Runs of words that repeat with a period, found by block convolution.

A run of period q is at least 4q long, so its words that recur q later fill 3q places. At the scale
of periods from B to 2B - 1 blocks of B words are laid 2B apart: any 3B places hold one whole. The
sum of squared differences between a block and what follows it, at every distance of the scale, is
one convolution, taken exactly by a number theoretic transform; where the sum is zero the block
recurs. These distances are seeds, which are extended to both sides as far as the words agree.
"""

import functools
from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from usagelens.llm.rows import keyed
from usagelens.llm.words import mix, pieces, utf8, word_lists

#: 3 * 2**18 + 1, with a generator of its units. Products of residues, 64 of them summed, are exact
#: in double precision, so a transform is a few matrix products.
PRIME, GENERATOR = 786433, 10
_RADIX_BITS = 6
_LONGEST = 1 << 11
_AT_ONCE = 1 << 19
_TEXT = 1 << 22
_BASE = 0x9E3779B97F4A7C15

RUN = "struct<start:long,length:long,period:long>"


def _reduce(x: np.ndarray) -> np.ndarray:
    """Near a residue, from -PRIME to 2 PRIME, in place."""
    x -= np.floor(x * (1 / PRIME)) * PRIME
    return x


@functools.cache
def _steps(bits: int, inverse: bool) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """A transform of 2**bits values as steps: a radix, its matrix, and what the step's result is
    multiplied with before the next. The inverse undoes the steps from the last to the first."""
    parts = max(1, -(-bits // _RADIX_BITS))
    sizes = [bits // parts + (i < bits % parts) for i in range(parts)]
    steps, left = [], bits
    for size in sizes:
        root = pow(GENERATOR, (PRIME - 1) >> left, PRIME)
        if inverse:
            root = pow(root, -1, PRIME)
        power = np.ones(1 << left, np.int64)
        for i in range(1, 1 << left):
            power[i] = power[i - 1] * root % PRIME
        radix, rest = 1 << size, 1 << (left - size)
        one = np.arange(radix)
        matrix = power[np.outer(one, one) * rest % len(power)]
        twist = power[np.outer(one, np.arange(rest))] if rest > 1 else None
        steps.append((radix, matrix.astype(float), None if twist is None else twist.astype(float)))
        left -= size
    return steps


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number theoretic transform of each row, whose length is a power of two, at most 2**18.

    Values come in an order of their own, which the inverse takes; all are near residues.
    """
    rows, length = x.shape
    bits = length.bit_length() - 1
    steps = _steps(bits, inverse)
    if not inverse:
        lead = rows
        for radix, matrix, twist in steps:
            x = _reduce(matrix @ x.reshape(lead, radix, -1))
            if twist is not None:
                x = _reduce(x * twist)
            lead *= radix
        return x.reshape(rows, length)
    lead = rows * length
    for radix, matrix, twist in reversed(steps):
        lead //= radix
        x = x.reshape(lead, radix, -1)
        if twist is not None:
            x = _reduce(x * twist)
        x = _reduce(matrix @ x)
    return _reduce(x.reshape(rows, length) * float(pow(length, -1, PRIME)))


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo PRIME, between each block and its window from each of
    as many places as the block is long. Windows are twice as long as blocks."""
    size = blocks.shape[1]
    padded = np.zeros((len(blocks), 2 * size))
    padded[:, :size] = blocks[:, ::-1]
    product = transform(_reduce(transform(padded) * transform(windows.astype(float))), True)
    cross = product[:, size - 1 : 2 * size - 1].astype(np.int64)
    squares = np.zeros((len(windows), 2 * size + 1), np.int64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % PRIME).sum(1)
    return (own[:, None] + squares[:, size : 2 * size] - squares[:, :size] - 2 * cross) % PRIME


class _Extender:
    """How far words agree with those some distance on, by hashes of prefixes."""

    def __init__(self, codes: np.ndarray):
        self._power = np.full(len(codes) + 1, _BASE, np.uint64)
        self._power[0] = 1
        np.multiply.accumulate(self._power, out=self._power)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64)) * self._power[:-1], out=self._sums[1:])

    def _equal(self, first: np.ndarray, last: np.ndarray, distance: np.ndarray) -> np.ndarray:
        sums = self._sums
        here = (sums[last] - sums[first]) * self._power[distance]
        return here == sums[last + distance] - sums[first + distance]

    def reach(self, at: np.ndarray, distance: np.ndarray, most: np.ndarray, step: int):
        """The number of places from ``at``, up to ``most``, that agree; ``step`` 1 looks at the
        places from there on, -1 at those before."""
        low, high = np.zeros_like(at), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            first, last = (at, at + half) if step > 0 else (at - half, at)
            same = self._equal(first, last, distance)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def _exact(codes: np.ndarray, seed: int, distance: int, first: int, last: int) -> tuple[int, int]:
    """The places around ``seed`` that agree with those ``distance`` on, within a text."""
    apart = np.flatnonzero(codes[first : last - distance] != codes[first + distance : last]) + first
    i = int(np.searchsorted(apart, seed))
    before = int(apart[i - 1]) + 1 if i else first
    return before, int(apart[i]) if i < len(apart) else last - distance


def find_runs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of (start, end, period) of all runs of the texts in ``codes``.

    A text is the range from one of ``starts`` to one of ``ends``; between two of them lies one
    code or more that occurs once. A run has a smallest period, at least six words and four
    periods, and no further word on either side would keep the period.
    """
    longest = int((ends - starts).max(initial=0))
    found = [np.zeros((0, 3), np.int64)]
    if longest < 6:
        return found[0]
    values = (mix(codes.astype(np.uint64)) % np.uint64(PRIME)).astype(np.int64)
    values = np.concatenate([values, np.zeros(4 * _LONGEST, np.int64)])
    extend = _Extender(codes)
    cover = np.zeros(len(codes) + 1, np.int64)  # the furthest end of a run that began so far
    scale = 1
    while 4 * scale <= longest:
        size = min(scale, _LONGEST)
        if size == scale:
            covered = cover
        seeds = np.arange(0, len(codes), 2 * scale)
        text = np.searchsorted(starts, seeds, "right") - 1
        inside = (text >= 0) & (ends[text] - starts[text] >= 4 * scale)
        inside &= seeds + size + scale <= ends[text]
        seeds, limit, begin = seeds[inside], ends[text[inside]], starts[text[inside]]
        rows = max(1, _AT_ONCE // (2 * size))
        hits = [], []
        as_blocks = np.lib.stride_tricks.sliding_window_view(values, size)
        as_windows = np.lib.stride_tricks.sliding_window_view(values, 2 * size)
        for at in range(0, len(seeds), rows):
            block = as_blocks[seeds[at : at + rows]]
            for shift in range(scale, 2 * scale, size):
                place = np.minimum(seeds[at : at + rows] + shift, len(as_windows) - 1)
                row, off = np.nonzero(mismatches(block, as_windows[place]) == 0)
                hits[0].append(row + at)
                hits[1].append(off + shift)
        row = np.concatenate(hits[0]) if hits[0] else np.zeros(0, np.int64)
        distance = np.concatenate(hits[1]) if hits[1] else np.zeros(0, np.int64)
        seed, limit, begin = seeds[row], limit[row], begin[row]
        # What lies whole in a run of a period of at most ``size`` has no greater smallest period.
        open_ = (seed + distance + size <= limit) & (covered[seed] < seed + distance + size)
        seed, limit, begin, distance = seed[open_], limit[open_], begin[open_], distance[open_]
        before = extend.reach(seed, distance, seed - begin, -1)
        after = extend.reach(seed, distance, limit - distance - seed, 1)
        fits = (after >= size) & (before + after + distance >= np.maximum(6, 4 * distance))
        runs = {}
        for s, d, b, a, low, high in np.stack(
            [seed, distance, seed - before, seed + after, begin, limit], 1
        )[fits].tolist():
            if (b, a, d) in runs:
                continue
            if not np.array_equal(codes[b:a], codes[b + d : a + d]):  # a chance of the hashes
                b, a = _exact(codes, s, d, low, high)
            if a - s >= size and a + d - b >= max(6, 4 * d) and cover[b] < a + d:
                runs[b, a, d] = (b, a + d, d)
        if runs:
            new = np.array(list(runs.values()), np.int64)
            found.append(new)
            cover = cover.copy()
            np.maximum.at(cover, new[:, 0], new[:, 1])
            cover = np.maximum.accumulate(cover)
        scale *= 2
    return np.concatenate(found)


def _collapse(raw: bytes, keep: np.ndarray) -> bytes:
    kept, at = [], 0
    for words in word_lists(raw):
        chosen = b" ".join(compress(words, keep[at : at + len(words)].tolist()))
        if chosen:
            kept.append(chosen)
        at += len(words)
    return b" ".join(kept)


def _texts_runs(texts: list[bytes]):
    """For each text its number of words, its runs by start and period, and its kept words."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    coded, sizes = [], []
    for raw in texts:
        own = [np.fromiter(map(number.__getitem__, p), np.int64, len(p)) for p in word_lists(raw)]
        sizes.append(sum(map(len, own)))
        coded += [*own, np.full(1, -1)]
    codes = np.concatenate(coded)
    apart = np.flatnonzero(codes < 0)
    codes[apart] = len(number) + np.arange(len(apart))
    ends = apart
    starts = ends - np.array(sizes, np.int64)
    runs = find_runs(codes, starts, ends)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    keep = np.cumsum(gone) == 0
    first = np.searchsorted(runs[:, 0], starts)
    last = np.searchsorted(runs[:, 0], ends)
    for i, raw in enumerate(texts):
        own = runs[first[i] : last[i]] - [starts[i], 0, 0]
        own[:, 1] -= own[:, 0] + starts[i]
        yield sizes[i], own, _collapse(raw, keep[starts[i] : ends[i]])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, runs, collapsed``, one row per row of ``docs``.

    ``runs`` holds ``start, length, period`` in words, by start, then period; ``collapsed`` the
    words, joined by one space, that no run contains after its first period. Texts are taken some
    megabytes at a time and a longer one by itself, in memory of about 60 bytes a word of it. A
    null text counts as empty and, like one of fewer than six words, has no runs. Rows with equal
    texts, ids or both each get their row; other columns are ignored, whatever their names.
    """

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch["text"])
            for first, last in pieces(offsets, _TEXT):
                raw = data[offsets[first] : offsets[last]].tobytes()
                cuts = (offsets[first : last + 1] - offsets[first]).tolist()
                texts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
                sizes, runs, kept = zip(*_texts_runs(texts), strict=True)
                flat = np.concatenate(runs)
                fields = [pa.array(flat[:, c]) for c in range(3)]
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(first, last - first),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(ends),
                            pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
                        ),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    rows = keyed(docs, id_col, text_col).select("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<{RUN}>, collapsed string")
