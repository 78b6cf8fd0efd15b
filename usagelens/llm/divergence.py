"""How far the sources of a language differ in their words, pair by pair and word by word.

Most sources lack most terms, so a pair's sum over all terms is that of two lacking sources, times
the number of terms, with corrections: for each term that one of them has, and for each that both
have. The latter come from a frequent-pattern tree. A term is a row of the sources that have it, in
one order of sources; rows that begin alike share a path, and a node's correction with each of its
ancestors is taken once, times the number of terms whose rows run through the node.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.words import pieces, utf8
from usagelens.storage import store

_BETWEEN = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_FOLD = bytes.maketrans(_BETWEEN + _UPPER, b" " * len(_BETWEEN) + _UPPER.lower())
_PIECE = 1 << 22
_ENTRIES = 200_000
_AT_ONCE = 1 << 19


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, those of a few megabytes at a time."""
    for at, end in _cuts(text):
        yield text[at:end].translate(_FOLD).split()


def _cuts(text: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(text):
        end = min(at + _PIECE, len(text))
        while end < len(text) and text[end] not in _BETWEEN:
            end += 1
        yield at, end
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, c, d``: occurrences of a term and documents with it, in parts that
    belong together, from ``lang, source, text``. Few rows leave a task, as it adds up before."""

    def rows(sums):
        found = [(g, t, n, docs[t]) for g, (counts, docs) in sums.items() for t, n in counts.items()]
        groups, terms, counts, held = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in groups], pa.string()),
                pa.array([g[1] for g in groups], pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(held, pa.int64()),
            ],
            ["lang", "source", "term", "c", "d"],
        )

    def run(batches):
        sums: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            data, offsets = utf8(batch["text"])
            groups = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True))
            for first, last in pieces(offsets, _PIECE):
                raw = data[offsets[first] : offsets[last]].tobytes()
                cuts = (offsets[first : last + 1] - offsets[first]).tolist()
                for group, a, b in zip(groups[first:last], cuts, cuts[1:]):
                    if group not in sums:
                        sums[group] = Counter(), Counter()
                    counts, held = sums[group]
                    before, own = len(counts), set()
                    for terms in _terms(raw[a:b]):
                        counts.update(terms)
                        own.update(terms)
                    held.update(own)
                    size += len(counts) - before
                    if size > _ENTRIES:
                        yield rows(sums)
                        sums, size = {}, 0
        if size:
            yield rows(sums)

    kinds = "lang string, source string, term string, c long, d long"
    return docs.select("lang", "source", "text").mapInArrow(run, kinds)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10**9 count / total), in steps that stay within a long up to totals of 9 * 10**15;
    1 without a total."""
    digits, rest = F.lit(0).cast("long"), count
    total = F.nullif(total, F.lit(0).cast("long"))
    for _ in range(3):
        rest = rest * 1000
        digits, rest = digits * 1000 + _div(rest, total), rest % total
    return F.coalesce(digits + 1, F.lit(1).cast("long"))


def _div(a: Column, b: Column) -> Column:
    """The integer part of a quotient."""
    return F.call_function("div", a, b)


def _gap(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def tree_nodes(lengths: np.ndarray, bounds: np.ndarray, keys: np.ndarray, times: np.ndarray):
    """Nodes of the tree of sorted rows, depth by depth: the depth, one row of each node there, and
    the number of terms through it. Row i has ``keys[bounds[i]:]``, ``lengths[i]`` of them."""
    alive = np.arange(len(lengths))
    fresh = np.zeros(len(lengths), bool)
    fresh[:1] = True
    for depth in range(int(lengths.max(initial=0))):
        longer = lengths[alive] > depth
        # A row that ends here is the first of those that share its path so far.
        starts = np.flatnonzero(fresh)
        fresh[np.minimum(starts + 1, len(fresh) - 1)] |= ~longer[starts]
        alive, fresh = alive[longer], fresh[longer]
        own = keys[bounds[alive] + depth]
        fresh[1:] |= (own[1:] != own[:-1]).any(1)
        at = np.flatnonzero(fresh)
        yield depth, alive[at], np.add.reduceat(times[alive], at)


def _corrections(batches):
    """Sums of pair corrections by pairs of groups, from sorted rows and how often each occurs."""
    for batch in batches:
        rows = batch["path"]
        flat = rows.flatten()
        keys = np.stack([flat.field(i).to_numpy() for i in range(3)], 1)
        lengths = rows.value_lengths().to_numpy().astype(np.int64)
        bounds = np.cumsum(lengths) - lengths
        names, group = np.unique(keys[:, 0], return_inverse=True)
        sums: dict[int, int] = {}
        for depth, rows_of, times in tree_nodes(lengths, bounds, keys, batch["times"].to_numpy()):
            if not depth:
                continue
            step = max(1, _AT_ONCE // depth)
            for first in range(0, len(rows_of), step):
                begin = bounds[rows_of[first : first + step]]
                above = begin[:, None] + np.arange(depth)
                node = (begin + depth)[:, None]
                p, zero, q, none = keys[above, 1], keys[above, 2], keys[node, 1], keys[node, 2]
                more = _gaps(p, q) - _gaps(p, none) - _gaps(zero, q) + _gaps(zero, none)
                more *= times[first : first + step, None]
                pair = (group[above] * len(names) + group[node]).ravel()
                order = np.argsort(pair, kind="stable")
                at = np.flatnonzero(np.diff(pair[order], prepend=-1))
                added = np.add.reduceat(more.ravel()[order], at)
                for k, v in zip(pair[order][at].tolist(), added.tolist(), strict=True):
                    sums[k] = sums.get(k, 0) + v
        pairs = np.array(list(sums), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[pairs // max(len(names), 1)]),
                pa.array(names[pairs % max(len(names), 1)]),
                pa.array(list(sums.values()), pa.int64()),
            ],
            ["g", "o", "value"],
        )


def pair_corrections(paths: DataFrame) -> DataFrame:
    """``g, o, value`` in parts that belong together, from ``path``, an array of ``g, p, zero``.

    Equal rows are counted first, then dealt in ranges, so that those that begin alike are in one
    task or at the edges of two; a node cut in two is taken twice, each time for its own terms.
    """
    counted = paths.groupBy("path").agg(F.count("*").alias("times"))
    counted = store(counted, "term-rows")  # the ranges are found by a pass of their own
    ranged = counted.repartitionByRange("path").sortWithinPartitions("path")
    return ranged.mapInArrow(_corrections, "g long, o long, value long")


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 10,
    top: int = 10,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source's distance from the others of its
    language, and its ``top`` most over-used terms.

    Null texts, languages and sources are empty ones. A language keeps the terms in ``min_docs`` of
    its rows or more; rows repeated count again, ties of value go by item. A source of a language
    without kept terms has distance 0; a source alone in its language has no row of part ``pair``.
    Texts of any length are read some megabytes at a time, all columns but three are ignored, and
    an empty table gives no row.
    """
    empty = F.lit("")
    table = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), empty).alias("source"),
        F.coalesce(F.col(text_col), empty).alias("text"),
    )
    by_source = (
        count_terms(table)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    )
    kept = (
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("c").alias("c"),
            F.sum("d").alias("d"),
            F.collect_list(F.struct("source", F.col("c").alias("own"))).alias("sources"),
        )
        .filter(F.col("d") >= min_docs)
    )
    kept = store(kept.select("lang", "term", "c", "sources"), "kept-terms")
    entries = kept.select("lang", "term", "c", F.inline("sources"))
    totals = entries.groupBy("lang", "source").agg(F.sum("own").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n"))
    zero = F.lit(0).cast("long")
    size = F.col("n") + 2 * F.col("v")
    groups = (
        table.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n", "v", "lang_n"])
        .select("lang", "source", "n", "v", "lang_n")
        .withColumn("zero", _share(F.lit(2).cast("long"), size))
        .withColumn("g", F.monotonically_increasing_id())
    )
    groups = store(groups, "term-groups")
    held = entries.join(groups, ["lang", "source"])
    held = held.withColumn("p", _share(F.col("own") + 2, size)).withColumn(
        "q", _share(F.col("c") + 2, F.col("lang_n") + 2 * F.col("v"))
    )
    held = store(held.select("g", "lang", "term", "p", "q", "zero"), "term-shares")

    row = F.array_sort(F.collect_list(F.struct("g", "p", "zero"))).alias("path")
    paths = held.groupBy("lang", "term").agg(row).filter(F.size("path") > 1).select("path")
    both = pair_corrections(paths)

    others = groups.select("lang", F.col("g").alias("o"), F.col("zero").alias("none"))
    apart = F.col("g") != F.col("o")
    base = groups.join(others, "lang").filter(apart)
    base = base.select("g", "o", (F.col("v") * _gap(F.col("zero"), F.col("none"))).alias("value"))
    shares = held.groupBy("lang", "g", "p", "zero").agg(F.count("*").alias("times"))
    one = shares.join(others, "lang").filter(apart)
    more = _gap(F.col("p"), F.col("none")) - _gap(F.col("zero"), F.col("none"))
    one = one.groupBy("g", "o").agg(F.sum(F.col("times") * more).alias("value"))

    def turned(pairs):
        return pairs.select(F.col("o").alias("g"), F.col("g").alias("o"), "value")

    pairs = base.unionByName(one).unionByName(turned(one))
    pairs = pairs.unionByName(both).unionByName(turned(both))
    pairs = pairs.groupBy("g", "o").agg(F.sum("value").alias("value"))
    named = groups.select(F.col("g").alias("o"), F.col("source").alias("item"))
    pairs = pairs.join(named, "o").select("g", F.lit("pair").alias("part"), "item", "value")
    above = held.filter("p > q").select(
        "g", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value")
    )

    def ranked(rows):
        order = Window.partitionBy("g").orderBy(F.desc("value"), "item")
        return rows.withColumn("rank", F.row_number().over(order))

    result = ranked(pairs).unionByName(ranked(above).filter(F.col("rank") <= top))
    return result.join(groups.select("g", "lang", "source"), "g").select(
        "lang", "source", "part", "item", "value", "rank"
    )
