"""Packing token sequences: shortest pack first over the histogram of lengths.

Only the histogram, one count per length up to the capacity, reaches the driver. It is packed
there into patterns of lengths with counts; documents' pieces then find their places by rank.
"""

import base64
import json
import re
import sys
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.rows import keyed
from usagelens.llm.words import pieces as row_ranges
from usagelens.llm.words import utf8
from usagelens.storage import store

_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_GAP = re.compile(f"[{_SPACE}]{{256,}}")
_BREAK = re.compile(r"(?<=[!-~]) (?=[!-~])")
_TEXT = 1 << 20
_LONG = 1 << 16
_PIECES_AT_ONCE = 1 << 13


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens of a ``tokenizers`` file, which it finds in any text by name."""
    with open(path, encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    for token in listed:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"{token['content']} is matched by more than its name")
    return {token["content"]: token["id"] for token in listed}


class Tokens:
    """Token ids of texts by a byte-level vocabulary of ranks.

    Names in ``added`` have the id given there wherever they occur, and the text is split at them;
    other names are ordinary text. Long texts are encoded part by part, cut where nothing merges:
    before a single space between two printable characters. Of a long run of white space all but
    the last character, or all at the end of a text, are one word of the splitting pattern; it is
    encoded as such, as the pattern itself would be followed back too far.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            lines = (line.split() for line in file)
            ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        encoding = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._ordinary, self._word = encoding.encode_ordinary, encoding._encode_single_piece
        added = added or {}
        self.width = 2 if max([*ranks.values(), *added.values()]) < 1 << 16 else 4
        self._kind = "H" if self.width == 2 else "I"
        self._added = added
        names = sorted(map(re.escape, added), key=len, reverse=True)
        self._names = re.compile(f"({'|'.join(names)})") if names else None

    def encode(self, text: str) -> array:
        """Ids as unsigned numbers of ``width`` bytes."""
        named = any(map(text.__contains__, self._added))
        if not named and len(text) < _LONG:
            return array(self._kind, self._ordinary(text))
        ids = array(self._kind)
        for i, part in enumerate(self._names.split(text) if named else [text]):  # names are at the odd places
            if i % 2:
                ids.append(self._added[part])
            else:
                self._encode_long(part, ids)
        return ids

    def _encode_long(self, text: str, ids: array) -> None:
        at = 0
        for gap in _GAP.finditer(text):
            self._encode_cut(text[at : gap.start()], ids)
            at = gap.end() - (gap.end() < len(text))
            ids.extend(self._word(text[gap.start() : at]))
        self._encode_cut(text[at:], ids)

    def _encode_cut(self, text: str, ids: array) -> None:
        at = 0
        while len(text) - at > _TEXT:
            cut = _BREAK.search(text, at + _TEXT)
            if cut is None:
                break
            ids.extend(self._ordinary(text[at : cut.start()]))
            at = cut.start()
        ids.extend(self._ordinary(text[at:]))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """``k, x, id, start, length, ids, width, doc_tokens``: each document's ids, ended by
    ``end_id``, cut into pieces of at most ``capacity``. ``ids`` holds little-endian unsigned numbers
    of ``width`` bytes, two where all ids of the vocabulary fit, else four. A null text counts as
    empty and has one piece with the end alone. ``added`` are the ids of added tokens by name.
    """

    def run(batches):
        tokens = Tokens(tokenizer_path, added)
        for batch in batches:
            _, offsets = utf8(batch["text"])
            for first, last in row_ranges(offsets):
                encoded = [tokens.encode(batch["text"][i].as_py()) for i in range(first, last)]
                for ids in encoded:
                    ids.append(end_id)
                yield from _cut(batch, first, encoded, tokens.width, capacity)

    rows = keyed(docs, id_col, text_col).select("k", "x", "id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"k long, x long, id {kind}, start long, length long, ids binary, width int, "
        "doc_tokens long"
    )
    return rows.mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch, first: int, encoded: list[array], width: int, capacity: int):
    """Record batches of the pieces of consecutive documents, some thousand pieces each."""
    counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
    if sys.byteorder == "big":
        for ids in encoded:
            ids.byteswap()
    data = b"".join(encoded)
    pieces = -(-counts // capacity)
    rows = np.repeat(np.arange(len(encoded)), pieces)
    starts = (np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
    lengths = np.minimum(capacity, counts[rows] - starts)
    ends = np.cumsum(lengths) * width
    for at in range(0, len(rows), _PIECES_AT_ONCE):
        part = slice(at, at + _PIECES_AT_ONCE)
        begin = int(ends[at] - lengths[at] * width)
        own = ends[part] - begin
        bounds = np.concatenate([[0], own]).astype(np.int32)
        ids = [None, pa.py_buffer(bounds), pa.py_buffer(data[begin : begin + int(own[-1])])]
        keys = batch.select(["k", "x", "id"]).take(pa.array(rows[part] + first))
        columns = [
            *keys.columns,
            pa.array(starts[part]),
            pa.array(lengths[part]),
            pa.BinaryArray.from_buffers(pa.binary(), len(own), ids),
            pa.array(np.full(len(own), width, np.int32)),
            pa.array(counts[rows[part]]),
        ]
        names = ["k", "x", "id", "start", "length", "ids", "width", "doc_tokens"]
        yield pa.RecordBatch.from_arrays(columns, names)


def pack_histogram(
    histogram: dict[int, int], capacity: int
) -> list[tuple[dict[int, int], int, int]]:
    """Patterns (how often each length occurs in one), how many packs follow each, and their fill.

    Lengths are placed longest first, each into the packs that are shortest so far, and into new
    packs if it fits in none. Packs of one pattern are placed together: a step uses up either all
    of a length or all packs of a pattern.
    """
    by_space: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max(by_space, default=0)
            if space < length:
                by_space.setdefault(capacity - length, []).append(({length: 1}, left))
                break
            pattern, packs = by_space[space].pop()
            placed = min(packs, left)
            if packs > placed:
                by_space[space].append((pattern, packs - placed))
            elif not by_space[space]:
                del by_space[space]
            more = pattern | {length: pattern.get(length, 0) + 1}
            by_space.setdefault(space - length, []).append((more, placed))
            left -= placed
    return [
        (pattern, packs, capacity - space)
        for space, group in sorted(by_space.items())
        for pattern, packs in group
    ]


def _places(histogram: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, first sequence, uses per sequence, first offset)."""
    places: dict[int, list[tuple[int, int, int, int]]] = {length: [] for length in histogram}
    ranks: Counter = Counter()
    sequence = 0
    for pattern, packs, _ in pack_histogram(histogram, capacity):
        offset = 0
        for length, uses in pattern.items():
            places[length].append((ranks[length], sequence, uses, offset))
            ranks[length] += packs * uses
            offset += length * uses
        sequence += packs
    return {length: np.array(rows, np.int64) for length, rows in places.items()}


def pack(
    pieces: DataFrame, order_by: list[str], capacity: int = 1024, stored: bool = False
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Pieces are ranked within their length: a range partitioning by length and ``order_by`` splits
    a length that is very frequent, each part is numbered from the count of the parts before it,
    and rank decides the place. Pieces equal in all of ``order_by`` may change places. The ranges
    are found by a pass of their own, so pieces are stored first unless they are ``stored``.
    """
    columns = pieces.columns
    pieces = pieces if stored else store(pieces, "pieces")
    part, before, rank = "_pack_part", "_pack_before", "_pack_rank"
    ranged = pieces.repartitionByRange("length", *order_by)
    ranged = store(ranged.withColumn(part, F.spark_partition_id()), "ranged-pieces")
    sizes = ranged.groupBy("length", part).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy(part)
    ahead = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    sizes = store(sizes.withColumn(before, F.coalesce(ahead, F.lit(0))), "piece-counts")
    totals = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    places = _places({r["length"]: r["n"] for r in totals}, capacity)
    within = Window.partitionBy("length", part).orderBy(*order_by)
    ranked = (
        ranged.join(sizes.select("length", part, before), ["length", part])
        .withColumn(rank, F.col(before) + F.row_number().over(within) - 1)
        .select(*columns, rank)
    )

    def run(batches):
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch[rank].to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths).tolist():
                mine = lengths == length
                table = places[length]
                row = table[np.searchsorted(table[:, 0], ranks[mine], "right") - 1]
                index = ranks[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + index // row[:, 2]
                offset[mine] = row[:, 3] + index % row[:, 2] * length
            kept = [batch[c] for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return ranked.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def _widen(batches):
    """Ids in four bytes each, whatever width they were stored in."""
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        if len(batch) and batch["width"][0].as_py() == 2:
            ids = batch["ids"]
            bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
            data = np.frombuffer(ids.buffers()[2], "<u2", (bounds[-1] - bounds[0]) // 2, bounds[0])
            buffers = [None, pa.py_buffer((bounds - bounds[0]) * 2), pa.py_buffer(data.astype("<u4"))]
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(ids), buffers)
            batch = batch.set_column(at, "ids", ids)
        yield batch


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """``id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``, one row per piece.

    A sequence is its pieces' ``ids`` by ``offset``, little-endian unsigned 32-bit numbers. Pieces
    are numbered and stored, placed without their ids, and joined with their places by number, so
    the ids are shuffled once, in two bytes each if the vocabulary allows. Texts of any length are
    encoded part by part, though a document's ids are in memory at once. A null text counts as
    empty; rows with equal ids and texts may change places, and other columns are ignored.
    """
    cut = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, added=added)
    cut = store(cut.withColumn("piece", F.monotonically_increasing_id()), "token-pieces")
    narrow = cut.select("piece", "k", "x", "start", "length")
    placed = pack(narrow, ["k", "x", "start"], capacity, stored=True)
    own = cut.drop("k", "x")
    joined = own.join(placed.select("piece", "sequence_id", "offset"), "piece").drop("piece")
    return joined.mapInArrow(_widen, joined.schema).select(
        "id",
        "start",
        "length",
        "ids",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
