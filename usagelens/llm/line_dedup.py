"""Boilerplate lines, known by the number of distinct sites that have them.

A HyperLogLog sketch per line hash is merged by aggregation, so a line on any number of sites costs
one small sketch per task. Where an estimate is near the threshold, sites are counted exactly.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.rows import keyed
from usagelens.storage import store

_BLANK = " \t\n\x0b\x0c\r"


def spread_lines(
    lines: DataFrame, min_sites: int, margin: float = 0.1, log_buckets: int = 12
) -> DataFrame:
    """``h1, h2`` of the lines on ``min_sites`` distinct sites or more, from ``h1, h2, site``.

    A sketch of 4096 registers errs by about 1.6 %, so an estimate more than ``margin`` away from
    the threshold decides; lines nearer than that are counted exactly.
    """
    sketches = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", log_buckets).alias("sketch"))
    sites = F.hll_sketch_estimate("sketch").alias("sites")
    wide = sketches.select("h1", "h2", sites).filter(F.col("sites") >= min_sites * (1 - margin))
    wide = store(wide, "wide-lines")
    sure = F.col("sites") > min_sites * (1 + margin)
    near = lines.join(wide.filter(~sure), ["h1", "h2"], "left_semi").distinct()
    exact = near.groupBy("h1", "h2").count().filter(F.col("count") >= min_sites)
    return wide.filter(sure).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def drop_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = 10,
    max_broadcast_lines: int = 200_000,
) -> DataFrame:
    """``id, n_lines, n_removed, kept``, one row per row of ``docs``.

    Lines are compared without white space at their ends, by 96 bits of hash. Those without a word
    are kept and not counted. A missing site is a site of its own; a null text counts as empty.
    Repeated rows each get their row, and other columns are ignored. A text takes time in
    proportion to its lines. Only hashes and line numbers are shuffled to find the lines; each text is moved once, to meet
    the numbers of its lines that go.
    """
    site = F.coalesce(F.col(site_col).cast("string"), F.lit("\0"))
    rows = keyed(docs.withColumn("_line_site", site), id_col, text_col)
    body = F.btrim(F.col("line"), F.lit(_BLANK))
    lines = (
        rows.select(
            "k", "x", F.col("row._line_site").alias("site"), F.posexplode(F.split("text", "\n"))
        )
        .withColumnsRenamed({"col": "line", "pos": "number"})
        .filter(body != "")
        .select(
            "k", "x", "site", "number", F.xxhash64(body).alias("h1"), F.hash(body).alias("h2")
        )
    )
    spread = store(spread_lines(lines.select("h1", "h2", "site"), min_sites), "spread-lines")
    if spread.count() <= max_broadcast_lines:
        spread = F.broadcast(spread)
    gone = (
        lines.join(spread, ["h1", "h2"], "left_semi")
        .groupBy("k", "x")
        .agg(F.sort_array(F.collect_set("number")).alias("gone"))  # at most the lines of one text
    )
    texts = keyed(docs, id_col, text_col).select("k", "x", "id", "text")
    # One flag per line up to the last that goes, so that texts of many lines take linear time.
    before = lambda i: F.coalesce(F.get("gone", i - 1), F.lit(-1))
    flags = F.flatten(
        F.transform(
            "gone",
            lambda g, i: F.concat(
                F.array_repeat(F.lit(False), g - before(i) - 1), F.array(F.lit(True))
            ),
        )
    )
    stay = F.zip_with(F.split("text", "\n"), flags, lambda line, flag: F.when(flag, None).otherwise(line))
    every = F.size(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != ""))
    return texts.join(gone, ["k", "x"], "left").select(
        "id",
        every.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.array_join(stay, "\n"))  # which leaves nulls out
        .alias("kept"),
    )
