"""Call events: building them from call records, and their JSON message form."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import display_path
from usagelens.schemas import EVENT_MESSAGE

# Fixed value: ISO-8601 with microseconds and a numeric offset.
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def call_events(api_calls: DataFrame, scan_time: Column | datetime.datetime) -> DataFrame:
    """One event per call record, all stamped with the time of the scan.

    Call records with their place in the file give events an ``event_id``: the same for the same
    call of one scan however often it is sent, and another for any other.
    """
    stamp = (scan_time if isinstance(scan_time, Column) else F.lit(scan_time)).cast("timestamp")
    ids = []
    if {"line", "col"} <= set(api_calls.columns):
        parts = ["repo", "file", "line", "col", F.unix_micros(stamp)]
        named = F.to_json(F.struct(*[p if isinstance(p, str) else p.alias("at") for p in parts]))
        ids = [F.md5(named.cast("binary")).alias("event_id")]
    return api_calls.select(
        "repo",
        display_path(F.col("repo"), F.col("file")).alias("file"),
        "symbol_called",
        "library",
        "signature_shape",
        "is_external",
        "defining_file",
        "import_module",
        F.lit(None).cast("string").alias("commit_hash"),
        stamp.alias("timestamp"),
        *ids,
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages in one binary ``value`` column; null fields keep their key."""
    options = {"ignoreNullFields": "false", "timestampFormat": _TIME_FORMAT}
    return events.select(F.to_json(F.struct("*"), options).cast("binary").alias("value"))


def parse_events(messages: DataFrame, with_id: bool = False) -> DataFrame:
    """Events out of the JSON in ``value``, whichever of the two spellings a producer uses.

    A message that is not a JSON object gives a row of nulls, which windowing drops later.
    ``with_id`` adds ``event_id``, null where a producer gives none.
    """
    message = F.from_json(F.col("value").cast("string"), EVENT_MESSAGE)
    # Rows of an array: a filter on the event's time would be moved below a plain column and read
    # the JSON again, once for each field it asks for.
    event = messages.select(F.inline(F.array(message)))
    return event.select(
        F.coalesce("repo", "repo_name").alias("repo"),
        F.coalesce("file", "file_path").alias("file"),
        "library",
        F.coalesce("symbol", "symbol_called", "call_full_name").alias("symbol"),
        F.coalesce("symbol_called", "call_full_name", "symbol").alias("symbol_called"),
        "signature_shape",
        "is_external",
        "defining_file",
        "import_module",
        "commit_hash",
        F.coalesce("event_time", "timestamp").cast("timestamp").alias("event_time"),
        *(["event_id"] if with_id else []),
    )
