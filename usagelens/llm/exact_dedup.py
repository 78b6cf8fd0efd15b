"""Exact duplicates by composable polynomial fingerprints, checked chunk by chunk."""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.rows import keep, keyed
from usagelens.llm.words import utf8
from usagelens.storage import store

PRIMES = (1073741789, 1073741783, 1073741741, 1073741723)
_BASE = 69069
_BLOCK = 1 << 14


def _block_powers(primes: tuple[int, ...]) -> np.ndarray:
    """Powers for one block, highest first; products of a block add up exactly in a double."""
    out = np.empty((_BLOCK, len(primes)))
    for k, prime in enumerate(primes):
        power = 1
        for i in range(_BLOCK - 1, -1, -1):
            out[i, k] = power
            power = power * _BASE % prime
    return out


def combine(left, right, right_length: int, primes: tuple[int, ...] = PRIMES) -> tuple[int, ...]:
    """The fingerprint of two joined byte strings from theirs: shift the left one, then add."""
    return tuple(
        (a * pow(_BASE, right_length, p) + b) % p
        for a, b, p in zip(left, right, primes, strict=True)
    )


def fingerprint(data: np.ndarray, powers: np.ndarray, primes: tuple[int, ...] = PRIMES):
    """Residues of the polynomial whose coefficients are the bytes plus one."""
    total = (0,) * len(primes)
    for at in range(0, len(data), _BLOCK):
        block = data[at : at + _BLOCK]
        sums = (block + 1.0) @ powers[_BLOCK - len(block) :]
        part = [int(x) % p for x, p in zip(sums, primes, strict=True)]
        total = combine(total, part, len(block), primes)
    return total


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_bytes: int = 1 << 20,
    primes: tuple[int, ...] = PRIMES,
) -> DataFrame:
    """One row per (id, text): ``k, x, id, n_bytes, sha256, f0.., copies``.

    Texts are cut into segments that are hashed on their own. Each is shifted by the bytes that
    follow it, so a text's fingerprint is a plain sum over its segments in any order: a huge text
    never needs more than a segment in Python. ``copies`` counts repeated rows.
    """
    names = [f"f{k}" for k in range(len(primes))]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = keyed(docs, id_col, text_col).select(
        "k",
        "x",
        "id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.col("text").cast("binary").alias("data"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
    )
    cuts = F.sequence(F.lit(0).cast("long"), F.col("n_bytes"), F.lit(segment_bytes).cast("long"))
    plain = ["k", "x", "id", "n_bytes", "sha256"]
    segments = rows.select(*plain, "data", F.explode(cuts).alias("cut")).select(
        *plain,
        "cut",
        F.substring("data", (F.col("cut") + 1).cast("int"), F.lit(segment_bytes)).alias("segment"),
    )

    def residues(batches):
        powers = _block_powers(primes)
        for batch in batches:
            data, offsets = utf8(batch["segment"])
            after = batch["n_bytes"].to_numpy() - batch["cut"].to_numpy() - np.diff(offsets)
            out = []
            for i, shift in enumerate(after.tolist()):
                own = fingerprint(data[offsets[i] : offsets[i + 1]], powers, primes)
                out.append(combine(own, (0,) * len(primes), shift, primes) if shift else own)
            values = np.array(out, np.int64).reshape(-1, len(primes))
            columns = [batch[c] for c in (*plain, "cut")]
            columns += [pa.array(values[:, k]) for k in range(len(primes))]
            yield pa.RecordBatch.from_arrays(columns, [*plain, "cut", *names])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"k long, x long, id {kind}, n_bytes long, sha256 string, cut long"
    schema += "".join(f", {n} long" for n in names)
    sums = [
        F.expr(f"cast(sum({n}) div sum(if(cut = 0, 1, 0)) % {p} as long)").alias(n)
        for n, p in zip(names, primes, strict=True)
    ]
    copies = F.sum(F.when(F.col("cut") == 0, 1)).alias("copies")
    return segments.mapInArrow(residues, schema).groupBy(*plain).agg(*sums, copies)


def _chunks(rows: DataFrame, keys: list[str], chunk_bytes: int) -> DataFrame:
    ends = F.octet_length("data").cast("long")
    cuts = F.sequence(F.lit(0).cast("long"), ends, F.lit(chunk_bytes).cast("long"))
    cut_up = rows.select(*keys, "data", F.explode(cuts).alias("cut"))
    start = (F.col("cut") + 1).cast("int")
    return cut_up.select(*keys, "cut", F.substring("data", start, F.lit(chunk_bytes)).alias("chunk"))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    primes: tuple[int, ...] = PRIMES,
    chunk_bytes: int = 1 << 16,
    members_per_copy: int = 1024,
) -> DataFrame:
    """Groups of equal texts, one row per (id, text):
    ``k, x, id, copies, keep_id, group_size, kept, sha256``. The largest id of a group stays, and of repeated rows one.

    Texts with equal fingerprints are compared byte for byte, in chunks, with the group's largest
    id. A large group is split: each ``members_per_copy`` members get a copy of that text. Rows
    that differ after all form the next round's groups; there is no further round without any.
    A null text equals an empty one; a null id loses against any other and is kept if alone.
    """
    names = [f"f{k}" for k in range(len(primes))]
    group = ["n_bytes", *names]
    row = ["k", "x", *group]
    counts = (F.max("id").alias("head"), F.count("*").alias("members"))
    prints = store(fingerprints(docs, id_col, text_col, primes=primes), "fingerprints")
    repeated = prints.groupBy(*group).agg(*counts).filter("members > 1")
    members = prints.join(repeated, group).select(*row, "id", "head", "members")
    texts = keyed(docs, id_col, text_col)
    texts = texts.select("k", "x", F.col("text").cast("binary").alias("data"))
    pending = store(texts.join(members, ["k", "x"]), "equal-fingerprints")

    later, number = [], 0
    while True:
        parts = F.ceil(F.col("members") / members_per_copy).cast("int")
        salted = pending.withColumn("salt", F.pmod("k", parts).cast("int"))
        heads = pending.filter(F.col("id").eqNullSafe(F.col("head"))).dropDuplicates(group)
        heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        a = _chunks(salted, [*row, "salt"], chunk_bytes)
        b = _chunks(heads, [*group, "salt"], chunk_bytes).withColumnRenamed("chunk", "other")
        same = F.bool_and(F.col("chunk") == F.col("other")).alias("same")
        compared = a.join(b, [*group, "salt", "cut"]).groupBy(*row).agg(same)
        compared = store(compared, "compared")
        if number:
            later.append(compared.filter("same").select(*row, F.lit(number).alias("round")))
        rest = compared.filter("not same").select(*row)
        if rest.isEmpty():
            break
        number += 1
        left = pending.drop("head", "members").join(rest, row, "left_semi")
        pending = store(left.join(left.groupBy(*group).agg(*counts), group), "unequal")

    placed = prints.withColumn("round", F.lit(0))
    if later:
        moved = functools.reduce(DataFrame.unionByName, later).withColumnRenamed("round", "later")
        placed = prints.join(moved, row, "left").withColumn(
            "round", F.coalesce("later", F.lit(0))
        )
    totals = placed.groupBy(*group, "round").agg(
        F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"), F.max("k").alias("only")
    )
    out = placed.join(totals, [*group, "round"])
    nameless = F.col("keep_id").isNull() & (F.col("k") == F.col("only"))
    kept = F.coalesce((F.col("id") == F.col("keep_id")) | nameless, F.lit(False)).alias("kept")
    return out.select("k", "x", "id", "copies", "keep_id", "group_size", kept, "sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all columns."""
    kept = exact_groups(docs, id_col, text_col).filter("kept")
    return keep(docs, kept, id_col, text_col)
