"""Incremental scans: only what a change can reach is parsed and resolved again.

A folder holds generations. Each run adds one: the facts of the files it parsed, the calls of the
files it resolved, and a list of all files that says which generation has each file's rows. The
number of the last finished run is written last, so readers see one state or the next, and a run
that fails leaves nothing that counts; the next one writes over it.
"""

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.operators.extract import extract_facts
from usagelens.operators.import_graph import importers, moved_modules
from usagelens.operators.resolve import collect_api_calls
from usagelens.operators.tracking import content_delta, versions
from usagelens.schemas import API_CALLS, FACTS, SCANNED
from usagelens.sinks.tables import overwrite
from usagelens.storage import store

_KEY = ["repo", "path"]


class ScanCounts(NamedTuple):
    """A run's generation, and how many files there are, were parsed and were resolved in it."""

    generation: int
    files: int
    parsed: int
    resolved: int


def run_incremental_scan(sources: DataFrame, path: str, mode: str = "reference") -> ScanCounts:
    """Bring the facts and calls under ``path`` up to date with ``sources``, all files there are.

    Files added or changed are parsed. Their calls are resolved anew, and those of files that import
    a module which another file stands for now; no other answer depends on what changed. ``mode`` is
    that of ``collect_api_calls`` and must stay the same for a folder.

    Texts are read once to tell which changed, and those that did a second time; comparing and
    invalidating move paths and names only. Facts and calls of files that stay are not rewritten:
    rows replaced or removed are left behind until ``compact_scan``.
    """
    spark = sources.sparkSession
    before = _current(spark, path)
    generation = before + 1
    old = _listed(spark, path, before)
    delta = store(content_delta(old, versions(sources)), "scan-delta")
    fresh = delta.filter(F.col("change").isin("added", "changed")).select(*_KEY)
    texts = sources.select(*_KEY, "content")
    parse = texts.join(fresh, _KEY, "left_semi") if before else texts
    store(extract_facts(parse), "facts", ["kind"], f"{path}/facts/gen={generation}")

    is_fresh = F.col("change").isin("added", "changed")
    files = delta.filter("change <> 'removed'").withColumn(
        "facts_gen", F.when(is_fresh, generation).otherwise(F.col("facts_gen"))
    )
    facts = _facts(spark, path, files)
    affected = fresh
    if before:
        kept = files.filter("change = 'same'").select(*_KEY)
        reached = importers(facts, moved_modules(old, files)).join(kept, _KEY, "left_semi")
        affected = store(fresh.unionByName(reached), "scan-affected")
    needed = store(facts.join(affected, _KEY, "left_semi"), "scan-facts", ["kind"])
    calls = collect_api_calls(needed, files, external_only=False, mode=mode, with_place=True)
    store(calls.select(*API_CALLS.names), "calls", path=f"{path}/calls/gen={generation}")

    resolved = affected.withColumn("_resolved", F.lit(True))
    listed = files.join(resolved, _KEY, "left").withColumn(
        "calls_gen", F.when(F.col("_resolved"), generation).otherwise(F.col("calls_gen"))
    )
    total = _finish(spark, path, generation, listed)
    own = _listed(spark, path, generation).agg(
        F.count_if(F.col("facts_gen") == generation), F.count_if(F.col("calls_gen") == generation)
    )
    return ScanCounts(generation, total, *own.first())


def scanned_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of the last finished run: repo, path, and a hash and the size of each content."""
    return _listed(spark, path, _current(spark, path)).drop("facts_gen", "calls_gen")


def scanned_facts(spark: SparkSession, path: str) -> DataFrame:
    """The facts of all files of the last finished run."""
    return _facts(spark, path, _listed(spark, path, _current(spark, path)))


def scanned_calls(spark: SparkSession, path: str) -> DataFrame:
    """The calls of all files of the last finished run, local ones included, with their places."""
    return _calls(spark, path, _listed(spark, path, _current(spark, path)))


def compact_scan(spark: SparkSession, path: str) -> int:
    """Write facts and calls as one generation, without rows that no longer count; returns it.

    Folders of older generations are not read after that and may be removed once no reader that
    began before is left.
    """
    before = _current(spark, path)
    files, generation = _listed(spark, path, before), before + 1
    store(_facts(spark, path, files), "facts", ["kind"], f"{path}/facts/gen={generation}")
    store(_calls(spark, path, files), "calls", path=f"{path}/calls/gen={generation}")
    gen = F.lit(generation)
    _finish(spark, path, generation, files.withColumns({"facts_gen": gen, "calls_gen": gen}))
    return generation


def _finish(spark: SparkSession, path: str, generation: int, files: DataFrame) -> int:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SCANNED]
    total = overwrite(files.select(*columns), f"{path}/files/gen={generation}")
    note = spark.createDataFrame([(str(generation),)], "value string").coalesce(1)
    note.write.mode("overwrite").text(f"{path}/current")
    return total


def _current(spark: SparkSession, path: str) -> int:
    """The number of the last finished run, 0 before the first."""
    try:
        found = spark.read.text(f"{path}/current").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return int(found[0]) if found else 0


def _listed(spark: SparkSession, path: str, generation: int) -> DataFrame:
    if not generation:
        return spark.createDataFrame([], SCANNED)
    return spark.read.schema(SCANNED).parquet(f"{path}/files/gen={generation}")


def _facts(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    return _live(spark, f"{path}/facts", FACTS, files, "facts_gen", "path")


def _calls(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    return _live(spark, f"{path}/calls", API_CALLS, files, "calls_gen", "file")


def _live(spark, path, schema, files, generation, file):
    """The rows of each file in the generation that has its last ones."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField("gen", T.IntegerType())]))
    here = files.select("repo", F.col("path").alias(file), F.col(generation).alias("gen"))
    return rows.parquet(path).join(here, ["repo", file, "gen"], "left_semi").drop("gen")
