"""Load job: a Parquet table into a SQL table."""

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from usagelens.schemas import REPO_EXPOSURE, USAGE
from usagelens.sinks.database import load_table
from usagelens.sources.tables import read_parts

# Target table and required columns by what is loaded.
LOADS: dict[str, T.StructType] = {"api_usage": USAGE, "repo_exposure": REPO_EXPOSURE}


def run_load_job(
    spark: SparkSession,
    path: str,
    connection: Mapping[str, str],
    what: str = "api_usage",
    table: str | None = None,
    if_exists: str = "append",
    chunksize: int = 5000,
) -> int:
    """Load the Parquet parts under ``path``; returns the rows written, none if there are no parts."""
    parts = read_parts(spark, path)
    if parts is None:
        return 0
    required = LOADS[what].names
    return load_table(parts, table or what, connection, required, if_exists, chunksize)
