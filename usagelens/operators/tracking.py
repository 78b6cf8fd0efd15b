"""Which files are tracked, what changed, and what a scan found."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.extract import diagnostics, extract_facts, is_too_complex

_KEY = ["repo", "path"]


def file_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths ``added`` to or ``removed`` from the tracked set: repo, path, change.

    Both snapshots meet in one aggregation on (repo, path).
    """
    seen = (
        old.select(*_KEY, F.lit(True).alias("_old"), F.lit(False).alias("_new"))
        .unionByName(new.select(*_KEY, F.lit(False).alias("_old"), F.lit(True).alias("_new")))
        .groupBy(*_KEY)
        .agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    )
    return seen.filter(F.col("_old") != F.col("_new")).select(
        *_KEY, F.when(F.col("_new"), "added").otherwise("removed").alias("change")
    )


def versions(sources: DataFrame) -> DataFrame:
    """``repo, path, version, size``: what tells one content of a file from another. A null content
    counts as empty, as it is when parsed."""
    content = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    return sources.select(
        *_KEY, F.xxhash64(content).alias("version"), F.octet_length(content).cast("long").alias("size")
    )


def content_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """All files of two ``versions`` tables, with what became of each as ``change``: ``added``,
    ``removed``, ``changed`` or ``same``. Further columns of ``old`` are kept, null where added."""
    told = ["version", "size"]
    before = old.withColumnsRenamed({c: f"_old_{c}" for c in told}).withColumn("_old", F.lit(True))
    both = before.join(new.withColumn("_new", F.lit(True)), _KEY, "full")
    same = F.lit(True)
    for c in told:
        same &= F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(same, "same")
        .otherwise("changed")
    )
    return both.withColumn("change", change).drop("_old", "_new", *[f"_old_{c}" for c in told])


def add_tracked(tracked: DataFrame, added: DataFrame) -> DataFrame:
    """``tracked`` plus the files of ``added`` it does not hold yet; existing rows stay as is."""
    fresh = added.dropDuplicates(_KEY).join(tracked, _KEY, "left_anti")
    return tracked.unionByName(fresh)


def extract_added(sources: DataFrame, delta: DataFrame) -> DataFrame:
    """Facts of the files a delta added, and of no others."""
    added = delta.filter(F.col("change") == "added")
    return extract_facts(sources.join(added, _KEY, "left_semi"))


def extract_single(sources: DataFrame, repo: str, path: str) -> DataFrame:
    """Facts of one tracked file; ``KeyError`` if it is not tracked."""
    one = sources.filter((F.col("repo") == repo) & (F.col("path") == path))
    if one.isEmpty():
        raise KeyError(f"file is not tracked: {repo}/{path}")
    return extract_facts(one)


def scan_summary(facts: DataFrame, files: DataFrame, external_calls: DataFrame) -> DataFrame:
    """Tracked files, external calls and diagnostics per repo.

    ``too_complex`` counts those of the diagnostics that are the parser's limit, not the file's
    fault.
    """
    counted = ["tracked_files", "external_calls", "diagnostics", "too_complex"]
    failed = diagnostics(facts)
    parts = [files, external_calls, failed, failed.filter(is_too_complex(F.col("message")))]
    rows = None
    for name, part in zip(counted, parts):
        ones = part.select("repo", *[F.lit(int(c == name)).alias(c) for c in counted])
        rows = ones if rows is None else rows.unionByName(ones)
    return rows.groupBy("repo").agg(*[F.sum(c).alias(c) for c in counted])
