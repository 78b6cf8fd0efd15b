"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Within its source each document gets a virtual finish time: the words of its source up to and with
it, in shuffled order, divided by the source's target. Served in that order, every source is at
the same share of its target at any moment; the mix ends when the budget is spent.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.words import WORD
from usagelens.storage import store

PASSES = 3


def _key(id_col: str, text_col: str, seed: str) -> Column:
    """A place in the shuffled order, which only the row's content and the seed decide."""
    parts = [F.col(id_col).cast("string"), F.col(text_col)]
    first, second = [F.coalesce(x, F.lit("")) for x in parts]
    return F.md5(F.concat(F.lit(seed), F.lit(":"), first, F.lit(":"), second).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets of the sources in ``sizes`` (``source, source_size``), as ``place`` and ``target``.

    Sources in code point order, null last, take the weights in turn and share the whole budget,
    the sum of all sizes. No target exceeds ``PASSES`` times the source: with the sources ordered
    by cap over weight, the level at which those not capped share what the capped leave is the
    largest of all levels met on the way. One row per source is sorted; nothing else is.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("turn"))
    table = (
        sizes.withColumn("place", place)
        .withColumn("turn", (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
        .withColumn("weight", turn)
        .withColumn("cap", PASSES * F.col("source_size"))
    )
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    return (
        table.withColumn("level", left / F.sum("weight").over(after))
        .withColumn("level", F.max("level").over(whole))
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
        )
        .select("source", "source_size", "place", "target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    seed: str = "mix",
) -> DataFrame:
    """One row per document: ``key, id, size, source_size, target, copies, taken``.

    ``size`` counts words, a null text has none. A source below its target is served again, up to
    ``PASSES`` times; a text without words at most once. ``key`` is a digest of id and text, so
    the order, and with it the mix, is the same in every run.

    Running sums are made in two steps. Keys are uniform, so a source, however large, falls into
    about the root of all rows' number of buckets, each with that many rows at most; sums of whole
    buckets give each its start, and rows are only summed within their bucket. The end of the mix
    is found likewise, by ranges of finish times and then within the one range where the budget
    ends. No text is shuffled.
    """
    sized = docs.select(
        _key(id_col, text_col, seed).alias("key"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = store(sized, "sizes")
    rows = sized.count()
    buckets = math.isqrt(rows) + 1
    digits = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    sized = sized.withColumn("bucket", F.floor(digits * buckets / (1 << 28)))
    summed = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    summed = store(summed, "bucket-sizes")
    targets = source_targets(
        summed.groupBy("source").agg(F.sum("words").alias("source_size")), weights
    )
    targets = store(targets, "targets")
    earlier = (
        Window.partitionBy("source")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("words").over(earlier), F.lit(0))
    same = F.col("b.source").eqNullSafe(F.col("t.source"))
    offsets = (
        summed.withColumn("start", start)
        .alias("b")
        .join(targets.alias("t"), same)
        .select("b.source", "bucket", "start", "source_size", "place", "target")
    )
    same = F.col("d.source").eqNullSafe(F.col("o.source")) & (
        F.col("d.bucket") == F.col("o.bucket")
    )
    within = (
        Window.partitionBy("place", "bucket")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        sized.alias("d")
        .join(offsets.alias("o"), same)
        .select("key", "id", "size", "d.bucket", "start", "source_size", "place", "target")
        .withColumn("served", F.col("start") + F.sum("size").over(within))
        .drop("bucket", "start")
    )
    placed = store(placed, "finish-times")

    def turn(p: int | Column) -> Column:
        served = F.col("source_size") * p + F.col("served")
        finish = F.when(F.col("target") > 0, served / F.col("target")).otherwise(F.lit(0.0))
        passed = p if isinstance(p, Column) else F.lit(p)
        return F.struct(
            finish.alias("finish"), F.col("place"), F.col("key"), passed.cast("int").alias("p")
        )

    passes = F.explode(F.array(*[F.lit(p) for p in range(PASSES)]))
    items = placed.filter("size > 0").withColumn("p", passes)
    items = items.select("size", turn(F.col("p")).alias("turn"))
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    ranges = math.isqrt(rows) + 1
    ranged = items.withColumn("range", F.floor(F.col("turn.finish") * ranges))
    up_to = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    spent = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(up_to))
    )
    edge = spent.filter(F.col("upto") > budget).orderBy("range").first()
    last = None
    if edge is not None:
        in_turn = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
        last = (
            ranged.filter(F.col("range") == edge["range"])
            .withColumn("upto", F.sum("size").over(in_turn) + (edge["upto"] - edge["words"]))
            .filter(F.col("upto") <= budget)
            .agg(F.max("turn").alias("last"))
            .first()["last"]
        )

    def served(p: int) -> Column:
        if edge is None:
            return F.lit(True)
        if last is None:  # not even the first of this range
            return F.floor(turn(p)["finish"] * ranges) < edge["range"]
        end = F.struct(
            F.lit(last["finish"]),
            F.lit(last["place"]),
            F.lit(last["key"]),
            F.lit(last["p"]).cast("int"),
        )
        return turn(p) <= end

    again = sum((F.when(served(p), 1).otherwise(0) for p in range(1, PASSES)), F.lit(0))
    copies = F.when(served(0), 1).otherwise(0) + F.when(F.col("size") > 0, again).otherwise(0)
    return placed.withColumn("copies", copies.cast("long")).select(
        "key",
        "id",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def take_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "mix",
    **settings,
) -> DataFrame:
    """The rows of the mix with all columns of ``docs``; a document served again is a row again.

    Rows equal in id and text have one key and equal sizes; their copies are shared out evenly.
    """
    mixed = mix(docs, id_col, text_col, seed=seed, **settings)
    copies = mixed.groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    rows = docs.select(F.struct("*").alias("row"), _key(id_col, text_col, seed).alias("key"))
    joined = rows.join(copies.filter("copies > 0"), "key")
    among = F.row_number().over(Window.partitionBy("key").orderBy("copies"))
    share = F.floor((F.col("copies") + F.col("rows") - F.col("among")) / F.col("rows"))
    return (
        joined.withColumn("among", among)
        .withColumn("share", share.cast("int"))
        .filter("share > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("share"))))
        .select("row.*")
    )
