"""Scores of deprecated symbols as days close."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators.exposure import deprecated_usage
from usagelens.operators.usage import REPO_KEYS, days_as_usage
from usagelens.streaming.usage import DELAY, daily_usage_stream


def exposure_stream(
    messages: DataFrame, deprecated: DataFrame, delay: str = DELAY, once: bool = False
) -> DataFrame:
    """The closed days' usage of listed symbols with its score, as ``deprecated_usage`` gives it.

    ``deprecated`` is a table, not a stream. Its files are listed when it is read, so a run scores
    the days it closes by the list it finds; days written before keep the scores they had. The join
    keeps no state: it meets closed days only, after counts are combined. A hot symbol's days are
    spread by the list's broadcast while that is small, else by its files' shuffle.
    """
    days = daily_usage_stream(messages, REPO_KEYS, delay, once)
    return deprecated_usage(days_as_usage(days), deprecated)


def write_scores(scores: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scores to Parquet, and stop when the input is used up."""
    return (
        scores.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
