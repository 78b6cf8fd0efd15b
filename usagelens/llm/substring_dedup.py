"""Repeated passages of any texts, found from anchors of fixed blocks.

A window of ``size`` words always holds a whole block of ``block`` words that starts at a multiple
of ``block`` in its document, if ``2 * block <= size + 1``. So it is enough to index those blocks
and to look up every rolling window of a block's length: two equal windows of ``size`` words meet
in at least one anchor, the block of one and the same words in the other. From the anchors the
repeat is extended: every window of ``size`` words around an anchor is counted over the corpus,
and runs of windows found twice or more are the maximal repeats.

Documents are dealt into groups of a few megabytes, and a group is the unit that asks and gets
answers: it sends each distinct hash once, so a passage in a third of all documents is one entry
per group, and no pair of occurrences is ever formed.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.words import spans, utf8, window_hashes, window_starts, word_hashes

SIZE = 35
_ASKED = "bucket long, g long, hashes binary, checks binary, marks binary"
_ANSWER = "g long, hashes binary, checks binary"


def squeeze(ascending: np.ndarray, width: int) -> bytes:
    """Ascending numbers of ``width`` bytes as differences, byte by byte, which the shuffle then
    compresses."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unsqueeze(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _buffers(column: pa.ChunkedArray) -> list[bytes]:
    return [x.as_buffer() for chunk in column.chunks for x in chunk]


class _Group:
    """The words of a group's texts and their windows."""

    def __init__(self, table: pa.Table):
        self.data, offsets = utf8(table["text"])
        self.starts, self.ends, self.bounds = spans(self.data, offsets)

    def hashes(self, first: np.ndarray, size: int, which: int) -> np.ndarray:
        words = word_hashes(self.data, self.starts, self.ends, which)
        return window_hashes(words, first, size, which)


def _first_of_equal(hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
    return np.flatnonzero(new)


def _asked(g: int, bucket, hashes, checks, marks, width: int) -> pa.Table:
    """A row for each bucket with the group's distinct hashes; the marks of equal ones are merged."""
    order = np.lexsort((checks, hashes, bucket))
    bucket, hashes, checks, marks = (x[order] for x in (bucket, hashes, checks, marks))
    at = _first_of_equal(hashes, checks)
    if len(at):
        marks = np.logical_or.reduceat(marks, at)
    bucket, hashes, checks = bucket[at], hashes[at], checks[at]
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
    rows = [
        (
            int(bucket[a]),
            g,
            squeeze(hashes[a:b], width),
            checks[a:b].tobytes(),
            np.packbits(marks[a:b]).tobytes(),
        )
        for a, b in zip(edges, edges[1:], strict=False)
    ]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        ["bucket", "g", "hashes", "checks", "marks"],
    )


def _answer(table: pa.Table, width: int) -> pa.Table:
    """For each group the hashes of one bucket that another group has too, if any one is marked."""
    groups = table["g"].to_numpy()
    hashes = [unsqueeze(x, width) for x in _buffers(table["hashes"])]
    checks = [np.frombuffer(x, "<u4") for x in _buffers(table["checks"])]
    marks = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
        for x, h in zip(_buffers(table["marks"]), hashes, strict=True)
    ]
    owner = np.repeat(np.arange(len(groups)), [len(h) for h in hashes])
    hashes, checks, marks = map(np.concatenate, (hashes, checks, marks))
    order = np.lexsort((checks, hashes))
    hashes, checks, marks, owner = hashes[order], checks[order], marks[order], owner[order]
    at = _first_of_equal(hashes, checks)
    count = np.diff(np.append(at, len(hashes)))
    found = np.repeat((count > 1) & np.logical_or.reduceat(marks, at), count)
    hashes, checks, owner = hashes[found], checks[found], owner[found]
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(len(groups) + 1))
    rows = [
        (g, squeeze(hashes[order[a:b]], width), checks[order[a:b]].tobytes())
        for g, a, b in zip(groups.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        if b > a
    ]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        ["g", "hashes", "checks"],
    )


def _found(table: pa.Table, hashes: np.ndarray, checks: np.ndarray, width: int) -> np.ndarray:
    """Which of a group's windows occur twice within it, or were answered for."""
    out = np.zeros(len(hashes), bool)
    if not len(hashes):
        return out
    order = np.lexsort((checks, hashes))
    a, b = hashes[order], checks[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    if table.num_rows:
        answered = np.concatenate([unsqueeze(x, width) for x in _buffers(table["hashes"])])
        check = np.concatenate([np.frombuffer(x, "<u4") for x in _buffers(table["checks"])])
        by = np.argsort(answered, kind="stable")
        answered, check = answered[by], check[by]
        place = np.minimum(np.searchsorted(answered, hashes), len(answered) - 1)
        out |= (answered[place] == hashes) & (check[place] == checks)
    return out


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    group_bytes: int = 4 << 20,
    bucket_windows: int = 1 << 20,
) -> DataFrame:
    """``id, n_words, n_removed, removed, kept``, one row per row of ``docs``.

    A word is removed if a window of ``size`` words over it occurs at another place too, in the
    same document or in any. ``removed`` lists ranges of word numbers, the end exclusive; ``kept``
    is the rest, joined by single spaces. A null text has no words. Anchors are compared by 32 and
    more bits, which only select; the repeats themselves by 96 and more.
    """
    block = (size + 1) // 2
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = total // group_bytes + 1
    windows, per_group = total / 6, group_bytes / 6
    # Rows from a group to a bucket keep some length on large inputs, where buckets grow instead.
    per_bucket = min(32 * bucket_windows, max(bucket_windows, 64 * windows / per_group))
    buckets = math.ceil(windows / per_bucket) or 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(groups)).alias("g"),
        F.col(id_col).alias("id"),
        text.alias("text"),
    ).repartition("g")  # moved once: all three steps below read this exchange

    def anchors(group: _Group):
        """Rolling windows of a block's length: where, their bucket and hash, and if a block."""
        first, place = window_starts(group.bounds, block)
        words = np.diff(group.bounds)
        fits = np.repeat(words >= size, np.maximum(words - block + 1, 0))
        first, place = first[fits], place[fits]
        hashes = group.hashes(first, block, 0)
        bucket = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        return first, bucket, hashes >> np.uint64(32), place % block == 0

    def ask_anchors(table: pa.Table) -> pa.Table:
        _, bucket, hashes, marks = anchors(_Group(table))
        none = np.zeros(len(hashes), "<u4")
        return _asked(table["g"][0].as_py(), bucket, hashes, none, marks, 4)

    def around_anchors(group: _Group, answers: pa.Table) -> np.ndarray:
        """Windows of the full size that hold an anchor."""
        first, _, hashes, _ = anchors(group)
        hit = np.zeros(len(group.starts) + 1, np.int64)
        hit[first] = _found(answers, hashes, np.zeros(len(hashes), "<u4"), 4)
        upto = np.concatenate([[0], np.cumsum(hit)])
        first, _ = window_starts(group.bounds, size)
        return first[upto[first + size - block + 1] > upto[first]]

    def both(group: _Group, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        check = group.hashes(first, size, 1)
        return group.hashes(first, size, 0), check.astype("<u4")

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(table)
        hashes, checks = both(group, around_anchors(group, answers))
        bucket = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        marks = np.ones(len(hashes), bool)
        return _asked(table["g"][0].as_py(), bucket, hashes, checks, marks, 8)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(table)
        first, _ = window_starts(group.bounds, size)
        found = first[_found(answers, *both(group, first), 8)]
        change = np.zeros(len(group.starts) + 1, np.int64)
        change[found] += 1
        change[found + size] -= 1
        gone = np.cumsum(change)[:-1] > 0
        raw = group.data.tobytes()
        rows = []
        for i in range(table.num_rows):
            low, high = int(group.bounds[i]), int(group.bounds[i + 1])
            own = gone[low:high]
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
            ranges = [{"first": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
            if ranges:
                stay = low + np.flatnonzero(~own)
                pairs = zip(group.starts[stay].tolist(), group.ends[stay].tolist(), strict=True)
                kept = b" ".join([raw[a:b] for a, b in pairs])
            else:
                own_bytes = slice(group.starts[low], group.ends[high - 1]) if high > low else slice(0)
                kept = b" ".join(raw[own_bytes].split())
            rows.append((high - low, int(own.sum()), ranges, kept.decode("utf-8", "replace")))
        columns = list(zip(*rows, strict=True))
        ranges = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), ranges, pa.string()]
        made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(
            [table["id"].combine_chunks(), *made], ["id", "n_words", "n_removed", "removed", "kept"]
        )

    by_group = dealt.groupBy("g")
    asked = by_group.applyInArrow(ask_anchors, _ASKED)
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _answer(t, 4), _ANSWER)
    asked = by_group.cogroup(answers.groupBy("g")).applyInArrow(ask_windows, _ASKED)
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _answer(t, 8), _ANSWER)
    kind = dealt.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_removed long, "
    schema += "removed array<struct<first:int,end:int>>, kept string"
    return by_group.cogroup(answers.groupBy("g")).applyInArrow(remove, schema)
