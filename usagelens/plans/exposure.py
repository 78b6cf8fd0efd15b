"""Exposure job: monthly usage and the deprecated list in, the two score tables out."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators.exposure import (
    add_codes,
    deprecated_usage,
    exposure_of_parts,
    exposure_parts,
    merge_parts,
    repo_exposure,
)
from usagelens.schemas import DEPRECATED_USAGE
from usagelens.sinks.tables import overwrite
from usagelens.sources.tables import read_deprecated, read_usage
from usagelens.storage import store


def run_exposure_job(
    spark: SparkSession,
    usage_path: str,
    deprecated_path: str,
    deprecated_usage_path: str,
    repo_exposure_path: str,
) -> None:
    """Score usage and replace both outputs. The repo table is built from the stored first one."""
    scored = deprecated_usage(read_usage(spark, usage_path), read_deprecated(spark, deprecated_path))
    overwrite(scored, deprecated_usage_path)
    stored = spark.read.schema(DEPRECATED_USAGE).parquet(deprecated_usage_path)
    overwrite(repo_exposure(stored), repo_exposure_path)


_CODES = "symbol string, code long, increment int"
_PARTS = (
    "repo string, time_window timestamp, code_range long, symbols binary, exposure_score long, "
    "calls long, increment int"
)


def add_exposure(scored: DataFrame, path: str, increment: int) -> None:
    """Add the scores of new usage to the exposure kept under ``path``, as increment number so-and-so.

    Only the new usage is read: of older usage the sums and bitmaps are kept, and a dictionary that
    gives each symbol its bit. An increment that failed is added again under its number and
    replaces what it left; earlier ones cannot be, as later symbols have codes that follow.
    """
    spark = scored.sparkSession
    codes = _increments(spark, f"{path}/codes", _CODES)
    later = codes.filter(F.col("increment") > increment)
    if not later.isEmpty():
        raise ValueError(f"increment {increment} is not the last one")
    known = codes.filter(F.col("increment") < increment).select("symbol", "code")
    scored = store(scored.select("repo", "symbol_called", "time_window", "usage_count", "exposure_score"), "new-scores")
    fresh = add_codes(known, scored.select(F.col("symbol_called").alias("symbol")))
    fresh = store(fresh, "codes", path=f"{path}/codes/increment={increment}")
    parts = exposure_parts(scored, known.unionByName(fresh))
    store(parts, "parts", path=f"{path}/parts/increment={increment}")


def stored_exposure(spark: SparkSession, path: str) -> DataFrame:
    """What ``repo_exposure`` gives for all usage added so far."""
    return exposure_of_parts(_increments(spark, f"{path}/parts", _PARTS))


def compact_exposure(spark: SparkSession, path: str, compacted_path: str) -> None:
    """Copy the exposure kept under ``path`` with all its increments merged into the last one."""
    codes = _increments(spark, f"{path}/codes", _CODES)
    last = codes.agg(F.max("increment")).first()[0] or 0
    parts = merge_parts(_increments(spark, f"{path}/parts", _PARTS))
    store(codes.drop("increment"), "codes", path=f"{compacted_path}/codes/increment={last}")
    store(parts, "parts", path=f"{compacted_path}/parts/increment={last}")


def _increments(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
