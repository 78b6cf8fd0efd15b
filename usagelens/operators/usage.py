"""Usage counts per day and per month. All but the month roll-ups also run on streams."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import month_bucket

SYMBOL_KEYS = ("library", "symbol")
REPO_KEYS = ("repo", "library", "symbol", "symbol_called")


def daily_usage(
    events: DataFrame, keys: Sequence[str] = SYMBOL_KEYS, time: str = "event_time"
) -> DataFrame:
    """Calls per one-day window and key. Events without a time are dropped."""
    day = F.window(time, "1 day")
    return (
        events.groupBy(day.alias("_day"), *keys)
        .agg(F.count(F.lit(1)).alias("num_calls"))
        .select(
            *keys,
            "num_calls",
            F.col("_day.start").alias("event_day_start"),
            F.col("_day.end").alias("event_day_end"),
        )
    )


def monthly_usage(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Calls per repo, symbol and month. Events without a time are dropped."""
    return (
        events.filter(F.col(time).isNotNull())
        .groupBy("repo", "symbol_called", month_bucket(F.col(time)).alias("time_window"))
        .agg(F.count(F.lit(1)).alias("usage_count"))
    )


def library_days(repo_days: DataFrame) -> DataFrame:
    """Daily counts per library and symbol, summed over repos."""
    return repo_days.groupBy("library", "symbol", "event_day_start", "event_day_end").agg(
        F.sum("num_calls").alias("num_calls")
    ).select("library", "symbol", "num_calls", "event_day_start", "event_day_end")


def months_of_days(repo_days: DataFrame) -> DataFrame:
    """Monthly counts per repo and symbol from daily ones; UTC days nest in UTC months."""
    return repo_days.groupBy(
        "repo", "symbol_called", month_bucket(F.col("event_day_start")).alias("time_window")
    ).agg(F.sum("num_calls").alias("usage_count"))


def days_as_usage(repo_days: DataFrame) -> DataFrame:
    """Daily counts in the columns of monthly usage, the day as time window. Also on streams."""
    return repo_days.select(
        "repo",
        "symbol_called",
        F.col("event_day_start").alias("time_window"),
        F.col("num_calls").alias("usage_count"),
    )
