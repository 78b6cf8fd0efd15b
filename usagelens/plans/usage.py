"""Usage job: message stream in, closed days and their months out."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions import month_label
from usagelens.operators.usage import REPO_KEYS, months_of_days
from usagelens.schemas import REPO_USAGE_DAILY
from usagelens.streaming.usage import (
    DELAY,
    FILES_PER_FOLDER,
    StreamCounts,
    daily_usage_stream,
    finish,
    read_days,
    write_days,
)

_WIDTH = "spark.sql.shuffle.partitions"


def run_usage_job(
    messages: DataFrame,
    days_path: str,
    checkpoint_path: str,
    usage_path: str | None = None,
    delay: str = DELAY,
    state_partitions: int | None = None,
    files_per_folder: int = FILES_PER_FOLDER,
    by_library: bool = False,
    once: bool = False,
) -> StreamCounts:
    """Run the stream until its input is used up; then, if asked, bring the monthly table up to date.

    Returns how many rows were read, dropped and written. ``once`` drops repeats of an event; a
    checkpoint keeps to it or does without from its first run on.

    Days are kept per repo, library and symbol; ``library_days`` sums them over repos. The number
    of ``state_partitions`` is fixed by the first run on a checkpoint and holds for the stream
    alone. A checkpoint belongs to one folder layout.
    """
    spark = messages.sparkSession
    width = spark.conf.get(_WIDTH)
    if state_partitions is not None:
        spark.conf.set(_WIDTH, state_partitions)
    try:
        days = daily_usage_stream(messages, REPO_KEYS, delay, once)
        counts = finish(write_days(days, days_path, checkpoint_path, files_per_folder, by_library))
    finally:
        spark.conf.set(_WIDTH, width)
    if usage_path is not None:
        roll_up_months(spark, days_path, usage_path)
    return counts


def roll_up_months(spark: SparkSession, days_path: str, usage_path: str) -> None:
    """Replace the months that new days can belong to, in a table with one folder per month.

    A watermark only moves forward, so days written later are later days: months before the last
    one of the last successful roll-up are complete and are neither read nor written again. That
    month is noted beside the data once all folders are in place. A run that fails in between
    leaves the older note, and one that finds none builds every month.
    """
    note = f"{usage_path}/_rolled_up"
    days = read_days(spark, days_path, REPO_USAGE_DAILY, _noted_month(spark, note))
    (
        months_of_days(days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("time_window")
        .parquet(usage_path)
    )
    last = days.agg(F.max(month_label(F.col("event_day_start"))).alias("value")).first()[0]
    if last is not None:
        spark.createDataFrame([(last,)], "value string").coalesce(1).write.mode("overwrite").text(note)


def _noted_month(spark: SparkSession, note: str) -> str | None:
    try:
        found = spark.read.text(note).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found[0] if found else None
