"""Daily usage from a message stream: each day is written once, when its watermark has passed."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions import month_label
from usagelens.operators.events import parse_events
from usagelens.operators.usage import SYMBOL_KEYS, daily_usage
from usagelens.schemas import USAGE_DAILY

DELAY = "1 hour"
FILES_PER_FOLDER = 32
MONTH = "event_month"
_WRITTEN = "days_written"


class StreamCounts(NamedTuple):
    """What a run of a stream read, dropped and wrote, in rows.

    ``late`` rows came behind the watermark. Where events are counted once they are events; else
    counts of one task for a day and key, as they are combined before they meet the state.
    ``repeated`` ones are events counted before, known only where events are counted once.
    """

    read: int
    late: int
    repeated: int
    written: int


def daily_usage_stream(
    messages: DataFrame,
    keys: Sequence[str] = SYMBOL_KEYS,
    delay: str = DELAY,
    once: bool = False,
) -> DataFrame:
    """Daily counts of the events in ``messages``, allowing them to be ``delay`` late.

    Counts are combined before the shuffle, so a hot symbol costs one state row per day. Days the
    watermark has not passed stay in state; events behind it are dropped.

    ``once`` counts an event once however often its message comes, which topics written at least
    once need. Events are known by ``event_id``; one without any counts each time. A repeat finds
    its first in state until the watermark has passed both by ``delay``, and is late after that,
    so state holds the ids of about the last ``delay`` and nothing is counted twice, over restarts
    too. It costs a shuffle of the events by id.
    """
    events = parse_events(messages, with_id=once).withWatermark("event_time", delay)
    if once:
        known = F.coalesce("event_id", F.concat(F.lit("#"), F.uuid()))
        events = events.withColumn("event_id", known).dropDuplicatesWithinWatermark(["event_id"])
    return daily_usage(events, keys)


def write_days(
    days: DataFrame,
    path: str,
    checkpoint: str,
    files_per_folder: int = FILES_PER_FOLDER,
    by_library: bool = False,
) -> StreamingQuery:
    """Append closed days to Parquet, one folder per month, and stop when the input is used up.

    A later run goes on from ``checkpoint``. Rows are hashed into at most ``files_per_folder``
    tasks per folder, so there is neither a file per state partition nor one task that writes a
    month alone; raise it where a month is large. ``by_library`` makes one folder per library
    instead, for readers that expect it and corpora with few libraries: each run then writes to
    every one of them, and no month can be pruned.
    """
    days = days.observe(_WRITTEN, F.count(F.lit(1)).alias("rows"))
    part = F.pmod(F.xxhash64(*days.columns), F.lit(files_per_folder))
    folder = "library" if by_library else MONTH
    if not by_library:
        days = days.withColumn(MONTH, month_label(F.col("event_day_start")))
    return (
        days.repartition(folder, part)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(folder)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery, poll_seconds: int = 5) -> StreamCounts:
    """Wait for a run of ``write_days`` to end, and count its rows from the progress it reports."""
    batches = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(poll_seconds)
        batches |= {p["batchId"]: p for p in query.recentProgress}
    states = [s for p in batches.values() for s in p["stateOperators"]]
    return StreamCounts(
        read=sum(p["numInputRows"] for p in batches.values()),
        late=sum(s["numRowsDroppedByWatermark"] for s in states),
        repeated=sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states),
        written=sum(_observed(p) for p in batches.values()),
    )


def _observed(progress) -> int:
    seen = progress["observedMetrics"].get(_WRITTEN)
    return seen["rows"] if seen else 0


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType = USAGE_DAILY,
    since_month: str | None = None,
    compacted_path: str | None = None,
) -> DataFrame:
    """The days written so far; the schema is given, as a first run may close none.

    Of the months before ``since_month`` no file is opened, unless folders are by library. Months
    that ``compact_days`` has moved to ``compacted_path`` are read there and nowhere else.
    """
    days = spark.read.schema(T.StructType([*schema, T.StructField(MONTH, T.StringType())]))
    generation, moved_until = _compacted(spark, compacted_path) if compacted_path else (0, "")
    found = _since(days.parquet(path), max(since_month or "", moved_until)).select(*schema.names)
    if generation:
        parts = [f"{compacted_path}/gen={number}" for number in range(1, generation + 1)]
        full = days.option("basePath", compacted_path).parquet(*parts)
        found = found.unionByName(_since(full, since_month or "").select(*schema.names))
    return found


def _since(days: DataFrame, month: str) -> DataFrame:
    if not month:
        return days
    own = month_label(F.col("event_day_start"))
    return days.filter((F.col(MONTH).isNull() | (F.col(MONTH) >= month)) & (own >= month))


def compact_days(
    spark: SparkSession,
    path: str,
    compacted_path: str,
    schema: T.StructType = USAGE_DAILY,
    files_per_month: int = 1,
) -> str | None:
    """Copy the days of full months into few files each; returns the first month that is not.

    A stream adds files to the folder of a month with every run. A watermark only moves forward, so
    months before that of the last day written are full. Those not copied yet go to a generation of
    their own, and a small file that names it and the first month that stays is written last:
    readers follow it, so they see each month in one place, before, while and after. A run that
    fails in between is made up for by the next, which writes over its generation. Files of copied
    months under ``path`` may be removed once no reader that began before is left, but by the sink's
    own log only (its ``retention`` option).
    """
    generation, moved_until = _compacted(spark, compacted_path)
    days = spark.read.schema(T.StructType([*schema, T.StructField(MONTH, T.StringType())]))
    left = _since(days.parquet(path), moved_until)
    left = left.withColumn(MONTH, month_label(F.col("event_day_start")))
    last = left.agg(F.max(MONTH)).first()[0]
    if last is None or last <= moved_until:
        return moved_until or None
    full = left.filter(F.col(MONTH) < last)
    if not full.isEmpty():
        generation += 1
        part = F.pmod(F.xxhash64(*schema.names), F.lit(files_per_month))
        written = full.repartition(MONTH, part).write.mode("overwrite").partitionBy(MONTH)
        written.parquet(f"{compacted_path}/gen={generation}")
    note = spark.createDataFrame([(f"{generation} {last}",)], "value string").coalesce(1)
    note.write.mode("overwrite").text(f"{compacted_path}/current")
    return last


def _compacted(spark: SparkSession, path: str) -> tuple[int, str]:
    """The last finished generation, and the first month that is not in it or those before."""
    try:
        found = spark.read.text(f"{path}/current").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, ""
    generation, month = found[0].split(" ")
    return int(generation), month
