"""Near duplicates by SimHash, found with fuzzy keys from the binary Golay code.

The code's 4096 words of 23 bits lie 7 or more bits apart, and each word of 23 bits is within 3
bits of exactly one. A fingerprint has three segments. If two fingerprints differ in two bits or
fewer, one segment is equal and another differs in one bit at most. Of the equal one the bits are
the key; of the other one the nearest codeword, which lies within 4 bits of the other side's
segment and so is among the at most six codewords that side tries.
"""

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.components import components
from usagelens.llm.rows import keep, keyed
from usagelens.llm.words import utf8
from usagelens.storage import store

GENERATOR = 0xAE3
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SEED = 42
_PIECE = 1 << 22


@functools.cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of all 23-bit words, and for each remainder the error patterns of least weight
    and, where that is 3, those of weight 4; unused places repeat the first."""
    rest = np.zeros(1, np.uint32)
    for bit in range(23):
        x = 1 << bit
        for high in range(bit, 10, -1):
            if x >> high & 1:
                x ^= GENERATOR << (high - 11)
        rest = np.concatenate([rest, rest ^ np.uint32(x)])
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    weight = [0] * (1 << 11)
    for size in range(5):
        for bits in itertools.combinations(range(23), size):
            error = sum(1 << b for b in bits)
            place = found[rest[error]]
            if not place:
                weight[rest[error]] = size
            if not place or (size == 4 and weight[rest[error]] == 3):
                place.append(error)
    errors = np.array([p + p[:1] * (6 - len(p)) for p in found], np.uint32)
    return rest, errors


def codewords(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the 12-bit numbers of its codewords, nearest first, six columns."""
    rest, errors = golay()
    return (words[:, None] ^ errors[rest[words]]) >> np.uint32(11)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which fingerprints are stored, 6 columns, and those they look up, 36 columns."""
    parts = [
        ((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.uint32)
        for at, bits in SEGMENTS
    ]
    numbers = [codewords(p) for p in parts]
    looked = []
    for n, (i, j) in enumerate(itertools.permutations(range(len(SEGMENTS)), 2)):
        key = (np.uint64(n) << np.uint64(34)) | (parts[i].astype(np.uint64) << np.uint64(12))
        looked.append(key[:, None] | numbers[j].astype(np.uint64))
    stored = np.stack([k[:, 0] for k in looked], 1)
    return stored.astype(np.int64), np.concatenate(looked, 1).astype(np.int64)


def _word_pieces(text: bytes):
    """The text's words, a few megabytes at a time."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
        yield text[at:end].split()
        at = end


def simhash(text: bytes, size: int = 3, seed: int = SEED) -> int:
    """The fingerprint of a text: bit by bit the majority of its shingles' hashes, 0 without any.

    A to Z count as lower case; a text of fewer than ``size`` words is one shingle.
    """
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in _word_pieces(text.lower()):
        words = tail + words
        tail = words[-(size - 1) :] if size > 1 else []
        if len(words) < size:
            tail = words
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - size + 1].tolist()
        hashes = [
            xxhash.xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)
        ]
        total += len(hashes)
        as_bytes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(as_bytes, axis=1, bitorder="little").sum(0, dtype=np.int64)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), seed) if tail else 0
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3
) -> DataFrame:
    """``k, x, id, fp`` of each row, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch["text"])
            raw = data.tobytes()
            bounds = offsets.tolist()
            prints = [simhash(raw[a:b], size) for a, b in itertools.pairwise(bounds)]
            fp = np.array(prints, np.uint64).view(np.int64)
            columns = [batch["k"], batch["x"], batch["id"], pa.array(fp)]
            yield pa.RecordBatch.from_arrays(columns, ["k", "x", "id", "fp"])

    rows = keyed(docs, id_col, text_col).select("k", "x", "id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"k long, x long, id {kind}, fp long")


def links(prints: DataFrame, hot: int = 64) -> DataFrame:
    """Pairs ``(a, b)`` of the distinct fingerprints ``fp`` that connect all pairs within two bits.

    Keys under which ``hot`` fingerprints or fewer are stored are joined and each pair verified.
    Fingerprints that meet under a fuller key are linked another exact way, without pairs: two of
    them are within two bits if and only if some word is within one bit of both, so each is
    written under its 65 such words and linked to the least found there. At most 65 share a word.
    """

    def keys(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy()
            stored, looked = fuzzy_keys(fp.view(np.uint64))
            every = np.concatenate([stored, looked], 1)
            role = np.zeros(every.shape, bool)
            role[:, : stored.shape[1]] = True
            first = np.ones(every.shape, bool)
            for c in range(looked.shape[1]):  # a repeated codeword is looked up once
                if c % 6:
                    same = looked[:, c] == looked[:, c - c % 6]
                    first[:, stored.shape[1] + c] = ~same
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(every[first]),
                    pa.array(np.repeat(fp, first.sum(1))),
                    pa.array(role[first]),
                ],
                ["key", "fp", "stored"],
            )

    found = store(prints.mapInArrow(keys, "key long, fp long, stored boolean"), "fuzzy-keys")
    stored = found.filter("stored").select("key", "fp")
    looked = found.filter("not stored").select("key", F.col("fp").alias("other"))
    full = store(
        stored.groupBy("key").count().filter(F.col("count") > hot).select("key"), "full-keys"
    )
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= 2
    pairs = (
        stored.join(full, "key", "left_anti")
        .join(looked, "key")
        .filter(near & (F.col("fp") != F.col("other")))
        .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
        .distinct()
    )
    crowded = found.join(full, "key", "left_semi").select("fp").distinct()
    flips = [F.col("fp")] + [
        F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) * (i == 63))) for i in range(64)
    ]
    under = crowded.select("fp", F.explode(F.array(*flips)).alias("word"))
    met = under.groupBy("word").agg(F.collect_set("fp").alias("all"), F.min("fp").alias("a"))
    starred = met.filter(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    return pairs.unionByName(starred.filter("a < b").distinct())


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3
) -> DataFrame:
    """``k, x, id, fp, root, component``, one row per document.

    Documents are linked if their fingerprints differ in two bits or fewer; ``component`` is the
    smallest id reachable, ``root`` a fingerprint that names the group. Copies share one
    fingerprint and are merged before any are compared. A null id counts as larger than any other.
    """
    rows = store(fingerprints(docs, id_col, text_col, size), "simhashes")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    distinct = store(distinct, "distinct-simhashes")
    joined = components(links(distinct.select("fp")))
    rooted = distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = store(rooted.join(groups, "root").select("fp", "root", "component"), "near-groups")
    return rows.join(named, "fp").select("k", "x", "id", "fp", "root", "component")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, the smallest id of each group, with all columns."""
    grouped = near_groups(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("k"), F.col("x"))
    kept = grouped.groupBy("root").agg(F.min(order).alias("first"))
    return keep(docs, kept.select("first.k", "first.x"), id_col, text_col)
