"""

All queries run over the whole ``events`` table, either as usage events or as the code files
``usagelens.plans.event_corpus`` derives from it.
"""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import usagelens as ul
from usagelens import functions as fn
from usagelens.operators.exposure import with_default_severity
from usagelens.operators.usage import REPO_KEYS
from usagelens.plans import event_corpus as corpus
from usagelens.plans.exposure import add_exposure, run_exposure_job, stored_exposure
from usagelens.plans.incremental import run_incremental_scan, scanned_calls
from usagelens.plans.scan import run_scan_job
from usagelens.plans.usage import run_usage_job
from usagelens.schemas import (
    DEPRECATED_USAGE,
    REPO_EXPOSURE,
    REPO_USAGE_DAILY,
    USAGE,
    USAGE_DAILY,
)
from usagelens.sinks import overwrite, require_columns, send_events
from usagelens.sources import (
    code_folders,
    keep_libraries,
    keep_paths,
    read_deprecated,
    read_parts,
    read_usage,
)
from usagelens.storage import scratch_path, store
from usagelens.streaming import (
    compact_days,
    daily_usage_stream,
    exposure_stream,
    read_days,
    write_days,
    write_scores,
)

try:
    import corpus_pipeline
    from usagelens.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "usagelens.llm"):
        raise
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = llm.QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_ORACLES = llm.ORACLE_SQL | (
        {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    )

Query = Callable[[SparkSession, str], DataFrame]

SCAN_TIME = datetime.datetime(2024, 2, 1, tzinfo=datetime.timezone.utc)
FILES_PER_TASK = 100_000
FILES_AT_ONCE = 500_000

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(oracle: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        _QUERIES[function.__name__] = run
        _ORACLES[function.__name__] = oracle
        return run

    return register


def entry(spark: SparkSession) -> DataFrame:
    return _QUERIES["repo_exposure"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return _QUERIES | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _LLM_ORACLES


# --- shared inputs -----------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.usage_events(corpus.read_events(spark, sf_dir))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.code_sources(corpus.read_events(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sources(spark, sf_dir).select("repo", "path")


def _wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that code is made of, spread before it is made, so that no text is shuffled.

    There are more tasks for more events, so that what a task holds does not grow with them.
    """
    events = corpus.read_events(spark, sf_dir).select("event_id", "event_type", "user_id", "props")
    tasks = -(-events.count() // FILES_PER_TASK)  # told by the file's footer
    return ul.widen(events, max(spark.sparkContext.defaultParallelism, tasks))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ul.extract_facts(corpus.code_sources(_wide_events(spark, sf_dir)))


def _stored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(_facts(spark, sf_dir), "facts", ["kind"])


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ul.import_edges(_stored_facts(spark, sf_dir), _files(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = corpus.read_events(spark, sf_dir)
    usage = ul.monthly_usage(corpus.usage_events(events))
    return ul.deprecated_usage(usage, corpus.deprecated_symbols(events))


def _plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    times = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _joined(column: str, by: str = ",") -> Column:
    return F.concat_ws(by, column).alias(column)


def _flat_calls(df: DataFrame) -> DataFrame:
    """Call records with the signature shape as plain columns."""
    others = [c for c in df.columns if c != "signature_shape"]
    return df.select(
        *others,
        F.col("signature_shape.positional_count").alias("positional_count"),
        F.concat_ws(",", "signature_shape.keyword_args").alias("keyword_args"),
        F.col("signature_shape.has_varargs").alias("has_varargs"),
        F.col("signature_shape.has_varkw").alias("has_varkw"),
    )


# --- SQL building blocks ----------------------------------------------------------------------

# Usage events, as ``usage_events`` derives them.
_USAGE = """
WITH u AS (
  SELECT 'repo' || (user_id % 10) AS repo, event_type AS library,
         event_type || '.k' || json_extract_string(props, '$.k') AS symbol,
         event_type || '.k' || json_extract_string(props, '$.k') AS symbol_called, ts
  FROM events)
"""

# The deprecated list, with default severity.
_LISTED = """
, listed AS (
  SELECT event_type || '.k' || k AS symbol, event_type AS library, '1.' || k AS deprecated_in,
         (copy + 1) || '.0' AS removed_in, CASE WHEN k % 6 = 0 THEN 1 ELSE k % 6 END AS severity,
         event_type || '.new' || k AS replacement
  FROM (SELECT DISTINCT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events) JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR k < 5
  WHERE k < 50)
"""

_MONTHS = """
, months AS (
  SELECT repo, symbol_called, CAST(date_trunc('month', ts) AS TIMESTAMP) AS time_window,
         count(*) AS usage_count
  FROM u GROUP BY ALL)
"""

_SCORED = """
, scored AS (
  SELECT repo, symbol_called, time_window, usage_count, deprecated_in, removed_in, severity,
         replacement, usage_count * severity AS exposure_score
  FROM months JOIN listed ON symbol_called = symbol)
"""

_EXPOSED = """
SELECT repo, time_window, CAST(sum(exposure_score) AS BIGINT) AS exposure_score,
       CAST(sum(usage_count) AS BIGINT) AS total_deprecated_calls,
       count(DISTINCT symbol_called) AS unique_deprecated_apis
FROM scored GROUP BY ALL
"""

# The code files: ``e`` has one per event, ``h`` the helper files of each repo.
_CODE = """
WITH e AS (
  SELECT 'repo' || (user_id % 10) AS repo, event_type, json_extract_string(props, '$.k') AS k,
         CASE event_type WHEN 'view' THEN 'src/views/' WHEN 'error' THEN '.venv/lib/'
              ELSE 'pkg/' END || 'e' || event_id || '.py' AS path
  FROM events),
h AS (
  SELECT repo, path
  FROM (SELECT DISTINCT repo FROM e),
       (VALUES ('helpers.py'), ('pkg/helpers.py'), ('pkg/__init__.py')) AS f(path)),
files AS (SELECT repo, path FROM e UNION ALL SELECT repo, path FROM h)
"""

# One row per import alias; ``seq`` is its place in binding order.
_IMPORTS = """
, imported AS (
  SELECT repo, path, seq, line, col, alias_pos, is_from, module, level, name, local_name
  FROM e JOIN (VALUES
    ('click', 0, 1, 0, 0, false, 'clicklib', 0, NULL, 'm'),
    ('view', 0, 1, 0, 0, true, 'viewlib', 0, 'k', 'f'),
    ('view', 1, 1, 0, 1, true, 'viewlib', 0, 'util', 'util'),
    ('purchase', 0, 1, 0, 0, false, 'helpers', 0, NULL, 'helpers'),
    ('purchase', 1, 3, 4, 0, false, 'os.path', 0, NULL, 'os'),
    ('signup', 0, 1, 0, 0, true, 'helpers', 1, 'run', 'run')
  ) AS i(kind, seq, line, col, alias_pos, is_from, module, level, bare, local_name)
    ON event_type = kind, LATERAL (SELECT CASE bare WHEN 'k' THEN 'k' || k ELSE bare END AS name)
  UNION ALL
  SELECT repo, path, 0, 1, 0, 0, true, 'helpers', 1, 'run', 'run'
  FROM h WHERE path = 'pkg/__init__.py')
"""

_DEFINED = """
, defined AS (
  SELECT repo, path, seq, line, 0 AS col, d.kind, name
  FROM e JOIN (VALUES
    ('click', 1, 2, 'variable', 'LIMIT'),
    ('view', 2, 2, 'class', 'Page'),
    ('purchase', 2, 2, 'function', 'pay')
  ) AS d(event, seq, line, kind, name) ON event_type = event
  UNION ALL
  SELECT repo, path, 0, 1, 0, 'function', 'run' FROM h WHERE path <> 'pkg/__init__.py')
"""

_CALLS = """
, called AS (
  SELECT repo, path, line, col, base_name,
         CASE base_name WHEN 'm' THEN 'k' || k ELSE attrs END AS attr_chain,
         positional_count, keyword_args, has_varargs, has_varkw, event_type, k
  FROM e JOIN (VALUES
    ('click', 3, 0, 'm', '', 1, 'sep', false, true),
    ('view', 3, 0, 'f', '', 1, '', true, false),
    ('purchase', 4, 11, 'os', 'path.join', 1, 'b,x', false, false),
    ('purchase', 4, 24, 'helpers', 'run', 0, '', false, false),
    ('purchase', 4, 41, 'print', '', 1, '', false, false),
    ('signup', 2, 0, 'run', '', 0, '', false, false)
  ) AS c(event, line, col, base_name, attrs, positional_count, keyword_args, has_varargs,
         has_varkw) ON event_type = event)
"""

# What each called name resolves to; unbound ones (print) have no row.
_RESOLVED = _CALLS + """
, resolved AS (
  SELECT called.*, CASE base_name WHEN 'f' THEN 'viewlib.k' || k ELSE target END AS import_module,
         is_local, defining_file
  FROM called JOIN (VALUES
    ('m', 'clicklib', false, NULL),
    ('f', NULL, false, NULL),
    ('os', 'os.path', NULL, NULL),
    ('helpers', 'helpers', true, 'helpers.py'),
    ('run', 'helpers.run', NULL, NULL)
  ) AS r(bound, target, is_local, defining_file) ON base_name = bound)
, api AS (
  SELECT repo, path AS file, symbol_called, split_part(symbol_called, '.', 1) AS library,
         is_local IS NOT TRUE AS is_external, defining_file, import_module, positional_count,
         keyword_args, has_varargs, has_varkw
  FROM resolved, LATERAL (SELECT concat_ws('.', import_module, nullif(attr_chain, ''))
                                 AS symbol_called))
"""

_EDGES = """
, edges AS (
  SELECT repo, path, module, file, file IS NOT NULL AS is_local, names AS imported_names
  FROM e JOIN (VALUES
    ('click', 'clicklib', NULL, ''),
    ('view', 'viewlib', NULL, 'k'),
    ('purchase', 'helpers', 'helpers.py', ''),
    ('purchase', 'os.path', NULL, ''),
    ('signup', 'pkg.helpers', 'pkg/helpers.py', 'run')
  ) AS g(event, module, file, bare) ON event_type = event,
  LATERAL (SELECT CASE bare WHEN 'k' THEN 'k' || k || ',util' ELSE bare END AS names)
  UNION ALL
  SELECT repo, path, 'pkg.helpers', 'pkg/helpers.py', true, 'run'
  FROM h WHERE path = 'pkg/__init__.py')
"""


# --- usage and exposure -------------------------------------------------------------------------


@_query(
    _USAGE
    + """
SELECT library, symbol, count(*) AS num_calls, day AS event_day_start,
       day + INTERVAL 1 DAY AS event_day_end
FROM (SELECT library, symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM u) GROUP BY ALL
"""
)
def usage_daily(spark, sf_dir):
    return ul.daily_usage(_events(spark, sf_dir))


@_query(_USAGE + _MONTHS + "SELECT * FROM months")
def usage_monthly(spark, sf_dir):
    return _plain_time(ul.monthly_usage(_events(spark, sf_dir)))


@_query(
    _USAGE
    + """
SELECT library, symbol, count(*) AS num_calls, day AS event_day_start,
       day + INTERVAL 1 DAY AS event_day_end
FROM (SELECT library, symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM u
      WHERE library <> 'error') GROUP BY ALL
"""
)
def usage_daily_messages(spark, sf_dir):
    """Days of messages, some of which have no time."""
    time = F.when(F.col("library") != "error", F.col("event_time").cast("timestamp"))
    messages = ul.to_messages(
        _events(spark, sf_dir).select("repo", "library", "symbol_called", time.alias("timestamp"))
    )
    return _plain_time(ul.daily_usage(ul.parse_events(messages)))


@_query(_USAGE + _MONTHS + "SELECT * FROM months")
def usage_months_of_days(spark, sf_dir):
    days = ul.daily_usage(_events(spark, sf_dir), REPO_KEYS)
    return _plain_time(ul.months_of_days(days))


@_query(_ORACLES["usage_daily"])
def usage_library_days(spark, sf_dir):
    return ul.library_days(ul.daily_usage(_events(spark, sf_dir), REPO_KEYS))


@_query(
    _USAGE
    + "SELECT symbol, ts AS event_time, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_bucket"
    " FROM u"
)
def event_month_bucket(spark, sf_dir):
    bucket = fn.month_bucket(F.col("event_time")).alias("month_bucket")
    return _plain_time(_events(spark, sf_dir).select("symbol", "event_time", bucket))


@_query(
    _USAGE
    + """
SELECT CASE WHEN ok THEN repo END AS repo, CASE WHEN ok THEN library END AS library,
       CASE WHEN ok THEN symbol END AS symbol, CASE WHEN ok THEN ts END AS event_time
FROM (SELECT *, library <> 'error' AS ok FROM u)
"""
)
def event_json_roundtrip(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    messages = ul.to_messages(
        events.select("repo", "library", "symbol_called", F.col("event_time").alias("timestamp"))
    )
    # Error events are spoilt: their messages are no longer JSON.
    text = F.col("value").cast("string")
    is_error = F.get_json_object(text, "$.library") == "error"
    spoilt = F.when(is_error, F.concat(F.lit("#"), text)).otherwise(text).cast("binary")
    parsed = ul.parse_events(messages.select(spoilt.alias("value")))
    return _plain_time(parsed.select("repo", "library", "symbol", "event_time"))


@_query(_USAGE + "SELECT repo, library, symbol, symbol_called, ts AS event_time FROM u")
def event_field_aliases(spark, sf_dir):
    time = F.col("event_time").cast("timestamp")
    events = _events(spark, sf_dir)
    producer = ul.to_messages(
        events.filter(F.col("library").isin("click", "view")).select(
            "repo", "library", "symbol_called", time.alias("timestamp")
        )
    )
    consumer = ul.to_messages(
        events.filter(~F.col("library").isin("click", "view")).select(
            F.col("repo").alias("repo_name"),
            "library",
            "symbol",
            F.col("symbol_called").alias("call_full_name"),
            time.alias("event_time"),
        )
    )
    parsed = ul.parse_events(producer.unionByName(consumer))
    return _plain_time(parsed.select("repo", "library", "symbol", "symbol_called", "event_time"))


@_query(
    _USAGE
    + _LISTED
    + "SELECT symbol, library, deprecated_in, removed_in, severity, replacement FROM listed"
)
def deprecated_list(spark, sf_dir):
    return with_default_severity(corpus.deprecated_symbols(corpus.read_events(spark, sf_dir)))


@_query(
    _USAGE
    + _LISTED
    + "SELECT symbol, count(*) AS listed FROM listed GROUP BY ALL HAVING count(*) > 1"
)
def deprecated_list_repeats(spark, sf_dir):
    return ul.repeated_symbols(corpus.deprecated_symbols(corpus.read_events(spark, sf_dir)))


@_query(_USAGE + _LISTED + _MONTHS + _SCORED + "SELECT * FROM scored")
def deprecated_usage(spark, sf_dir):
    return _plain_time(_scored(spark, sf_dir))


@_query(_USAGE + _LISTED + _MONTHS + _SCORED + _EXPOSED)
def repo_exposure(spark, sf_dir):
    return _plain_time(ul.repo_exposure(_scored(spark, sf_dir)))


def _list_file(spark: SparkSession, sf_dir: str) -> str:
    """The deprecated list as a JSON array in a file."""
    path = scratch_path(spark, "list")
    listed = corpus.deprecated_symbols(corpus.read_events(spark, sf_dir))
    array = listed.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    array.select(F.replace("value", F.lit("},{"), F.lit("},\n{"))).write.text(path)
    return path


@_query(_ORACLES["deprecated_list"])
def deprecated_list_file(spark, sf_dir):
    return with_default_severity(read_deprecated(spark, _list_file(spark, sf_dir)))


def _run_exposure_job(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_path(spark, "exposure-job")
    overwrite(ul.monthly_usage(_events(spark, sf_dir)), f"{folder}/usage")
    paths = [f"{folder}/{name}" for name in ("usage", "scored", "exposed")]
    run_exposure_job(spark, paths[0], _list_file(spark, sf_dir), *paths[1:])
    return folder


@_query(_ORACLES["repo_exposure"])
def exposure_job(spark, sf_dir):
    folder = _run_exposure_job(spark, sf_dir)
    return _plain_time(spark.read.schema(REPO_EXPOSURE).parquet(f"{folder}/exposed"))


@_query(_ORACLES["repo_exposure"])
def exposure_increments(spark, sf_dir):
    """Exposure brought up to date with the second half of the month, then with what is left."""
    path, events = scratch_path(spark, "exposure"), corpus.read_events(spark, sf_dir)
    listed = corpus.deprecated_symbols(events)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    parts = [F.col("ts") >= "2024-01-15", (F.col("ts") < "2024-01-15") & (third == 0)]
    parts.append((F.col("ts") < "2024-01-15") & (third != 0))
    for number, part in enumerate(parts):
        usage = ul.monthly_usage(corpus.usage_events(events.filter(part)))
        add_exposure(ul.deprecated_usage(usage, listed), path, number)
    return _plain_time(stored_exposure(spark, path))


@_query(_ORACLES["deprecated_usage"])
def exposure_job_scores(spark, sf_dir):
    folder = _run_exposure_job(spark, sf_dir)
    return _plain_time(spark.read.schema(DEPRECATED_USAGE).parquet(f"{folder}/scored"))


# --- streams ------------------------------------------------------------------------------------


def _message_stream(spark: SparkSession, sf_dir: str, later: str = "0 days") -> DataFrame:
    """The events table as a stream of JSON messages."""
    schema = corpus.read_events(spark, sf_dir).schema
    # A glob, as a stream source must not be the path of a single file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    events = events.select("ts", "user_id", "event_type", "props")
    usage = corpus.usage_events(ul.widen(events, 2 * spark.sparkContext.defaultParallelism))
    return ul.to_messages(
        usage.select(
            "repo",
            "library",
            "symbol_called",
            (F.col("event_time") + F.expr(f"interval {later}")).cast("timestamp").alias("timestamp"),
        )
    )


def _run_stream(days: DataFrame, spark: SparkSession) -> str:
    folder = scratch_path(spark, "usage-stream")
    write_days(days, f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/days"


_CLOSED = " WHERE event_day_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@_query("SELECT * FROM (" + _ORACLES["usage_daily"] + ")" + _CLOSED)
def usage_stream_closed(spark, sf_dir):
    path = _run_stream(daily_usage_stream(_message_stream(spark, sf_dir)), spark)
    return _plain_time(read_days(spark, path, USAGE_DAILY))


@_query(
    _USAGE
    + """
, days AS (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM u)
SELECT repo, symbol_called, CAST(date_trunc('month', day) AS TIMESTAMP) AS time_window,
       count(*) AS usage_count
FROM days WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL
"""
)
def usage_stream_months(spark, sf_dir):
    path = _run_stream(daily_usage_stream(_message_stream(spark, sf_dir), REPO_KEYS), spark)
    return _plain_time(ul.months_of_days(read_days(spark, path, REPO_USAGE_DAILY)))


@_query(_ORACLES["usage_stream_months"])
def usage_stream_restart(spark, sf_dir):
    """The usage job over the first half of the month, then over the rest and some late messages."""
    folder = scratch_path(spark, "usage-job")
    events = corpus.read_events(spark, sf_dir)
    is_first = F.col("ts") < F.lit("2024-01-15")
    late = events.filter(~is_first).withColumns(
        {"ts": F.lit("2024-01-01T12:00:00").cast(events.schema["ts"].dataType)}
    )
    for name, part in (("1", events.filter(is_first)), ("2", events.filter(~is_first).union(late))):
        part.write.parquet(f"{folder}/inbox/{name}")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/inbox/*")
        usage = corpus.usage_events(stream).select(
            "repo",
            "library",
            "symbol_called",
            F.col("event_time").cast("timestamp").alias("timestamp"),
        )
        run_usage_job(
            ul.to_messages(usage), f"{folder}/days", f"{folder}/checkpoint", f"{folder}/usage"
        )
    return _plain_time(read_usage(spark, f"{folder}/usage"))


@_query("SELECT * FROM (" + _ORACLES["usage_daily"] + ")" + _CLOSED)
def usage_stream_once(spark, sf_dir):
    """Messages of which a third come twice, within a run and again after a restart."""
    folder = scratch_path(spark, "usage-once")
    events = corpus.read_events(spark, sf_dir)
    is_first = F.col("ts") < F.lit("2024-01-15")
    twice = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0)
    first, last = events.filter(is_first), events.filter(~is_first)
    inboxes = first.unionByName(twice.filter(is_first)), last.unionByName(twice)
    for name, part in enumerate(inboxes):
        part.write.parquet(f"{folder}/inbox/{name}")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/inbox/*")
        usage = corpus.usage_events(stream, with_id=True).select(
            "repo",
            "library",
            "symbol_called",
            "event_id",
            F.col("event_time").cast("timestamp").alias("timestamp"),
        )
        days = daily_usage_stream(ul.to_messages(usage), once=True)
        write_days(days, f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return _plain_time(read_days(spark, f"{folder}/days", USAGE_DAILY))


@_query(
    _USAGE
    + """
SELECT * FROM (
  SELECT library, symbol, count(*) AS num_calls, day AS event_day_start,
         day + INTERVAL 1 DAY AS event_day_end
  FROM (SELECT library, symbol, CAST(date_trunc('day', ts + INTERVAL 20 DAY) AS TIMESTAMP) AS day
        FROM u) GROUP BY ALL)
WHERE event_day_end <= (SELECT max(ts) FROM events) + INTERVAL 20 DAY - INTERVAL 1 HOUR
"""
)
def usage_days_compacted(spark, sf_dir):
    """Closed days of two months, the events being of 20 days later, the first from few files."""
    path = _run_stream(daily_usage_stream(_message_stream(spark, sf_dir, "20 days")), spark)
    compacted = scratch_path(spark, "compacted-days")
    compact_days(spark, path, compacted)
    return _plain_time(read_days(spark, path, USAGE_DAILY, compacted_path=compacted))


@_query(
    _USAGE
    + _LISTED
    + """
, days AS (
  SELECT repo, symbol_called, CAST(date_trunc('day', ts) AS TIMESTAMP) AS time_window,
         count(*) AS usage_count
  FROM u GROUP BY ALL)
SELECT repo, symbol_called, time_window, usage_count, deprecated_in, removed_in, severity,
       replacement, usage_count * severity AS exposure_score
FROM days JOIN listed ON symbol_called = symbol
WHERE time_window + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""
)
def exposure_stream_closed(spark, sf_dir):
    folder = scratch_path(spark, "exposure-stream")
    listed = corpus.deprecated_symbols(corpus.read_events(spark, sf_dir))
    overwrite(listed, f"{folder}/listed")
    listed = spark.read.parquet(f"{folder}/listed")
    scores = exposure_stream(_message_stream(spark, sf_dir), listed)
    write_scores(scores, f"{folder}/scores", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.schema(DEPRECATED_USAGE).parquet(f"{folder}/scores")
    return _plain_time(found)


# --- code facts ---------------------------------------------------------------------------------


@_query(_CODE + _IMPORTS + "SELECT * FROM imported")
def code_imports(spark, sf_dir):
    return ul.imports(_facts(spark, sf_dir)).drop("is_aliased", "statement_names")


@_query(_CODE + _IMPORTS + "SELECT * FROM imported")
def code_imports_balanced(spark, sf_dir):
    """Imports of files spread over tasks by their bytes."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    facts = ul.extract_facts(ul.balance(_sources(spark, sf_dir), tasks))
    return ul.imports(facts).drop("is_aliased", "statement_names")


def _write_folders(sources: DataFrame, folder: str) -> list[str]:
    """Writes each source as a file below ``folder``, in tasks; returns the repos' roots."""

    def write(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        system, base = FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            for repo, path, content in zip(*(batch[i].to_pylist() for i in range(3))):
                name = f"{base}/{repo}/{path}"
                parent = name.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent)
                    made.add(parent)
                with system.open_output_stream(name) as file:
                    file.write(content.encode())
            yield pa.RecordBatch.from_arrays([batch[0]], ["repo"])

    written = sources.select("repo", "path", "content").mapInArrow(write, "repo string")
    return [f"{folder}/{r.repo}" for r in written.distinct().collect()]  # few repos


def _remove_folders(spark: SparkSession, roots: list[str]) -> None:
    """Removes what lies below each root, in tasks."""

    def remove(batches):
        from pyarrow.fs import FileSystem

        for batch in batches:
            for root in batch[0].to_pylist():
                system, base = FileSystem.from_uri(root)
                system.delete_dir_contents(base, missing_dir_ok=True)  # a task may run twice
            yield batch

    given = spark.createDataFrame([(root,) for root in roots], "root string")
    wide = spark.sparkContext.defaultParallelism
    given.repartition(wide, "root").mapInArrow(remove, given.schema).collect()


def _in_turns(sources: DataFrame, files: int) -> list[DataFrame]:
    """The ``files`` sources, stored in parts of about ``FILES_AT_ONCE``; equal paths share one."""
    turns = max(1, -(-files // FILES_AT_ONCE))
    wide = sources.sparkSession.sparkContext.defaultParallelism
    task = F.pmod(F.xxhash64("repo", "path"), F.lit(turns * wide)).cast("int")
    placed = sources.withColumn("_task", task).repartitionById(turns * wide, "_task")
    turn = F.floor(F.col("_task") / wide).cast("int").alias("_turn")
    stored = store(placed.select(*sources.columns, turn), "sources", ["_turn"])
    return [stored.filter(F.col("_turn") == i).drop("_turn") for i in range(turns)]


@_query(_CODE + _IMPORTS + "SELECT * FROM imported")
def code_folder_imports(spark, sf_dir):
    """Imports of the files once they lie in folders, read through the data source.

    A disk has room for only so many small files, so they lie there in turns: those of one are
    written, read, and removed once their imports are stored.
    """
    sources = corpus.code_sources(_wide_events(spark, sf_dir))
    places, folder = [], scratch_path(spark, "code")
    for turn in _in_turns(sources, _files(spark, sf_dir).count()):
        roots = _write_folders(turn, f"{folder}/{len(places)}")
        facts = ul.extract_facts(code_folders(spark, roots, 1 << 18))
        imports = ul.imports(facts).drop("is_aliased", "statement_names")
        places.append(scratch_path(spark, "imports"))
        store(imports, "imports", path=places[-1])
        _remove_folders(spark, roots)
    return spark.read.schema(imports.schema).parquet(*places)


@_query(_CODE + _DEFINED + "SELECT * FROM defined")
def code_definitions(spark, sf_dir):
    return ul.definitions(_facts(spark, sf_dir))


@_query(_CODE + _CALLS + "SELECT repo, path, line, col, base_name, attr_chain FROM called")
def code_calls(spark, sf_dir):
    return ul.calls(_facts(spark, sf_dir)).select(
        "repo", "path", "line", "col", "base_name", _joined("attr_chain", ".")
    )


@_query(
    _CODE
    + _CALLS
    + "SELECT repo, path, line, col, positional_count, keyword_args, has_varargs, has_varkw"
    " FROM called"
)
def call_signature(spark, sf_dir):
    return _flat_calls(
        ul.calls(_facts(spark, sf_dir)).select("repo", "path", "line", "col", "signature_shape")
    )


@_query(
    _CODE
    + """
SELECT repo, path, 'invalid syntax (' || split_part(path, '/', 3) || ', line 1)' AS message,
       1 AS line, 14 AS "column"
FROM e WHERE event_type = 'error'
"""
)
def code_diagnostics(spark, sf_dir):
    return ul.diagnostics(_facts(spark, sf_dir))


# --- bindings -----------------------------------------------------------------------------------

_BOUND = (
    _IMPORTS
    + _DEFINED
    + """
, bound AS (
  SELECT repo, path, local_name AS name, seq, concat_ws('.', module, name) AS target,
         '<import>;' || CASE WHEN is_from THEN 'from ' || module || ' import ' || name
                             ELSE 'import ' || module END
         || ' as ' || local_name || '  (' || path || ' @ offset ' || line || ')' AS declaration
  FROM imported
  UNION ALL
  SELECT repo, path, name, seq, NULL,
         '<' || kind || '>;' || CASE kind WHEN 'function' THEN 'def ' || name || '(...)'
                                          WHEN 'class' THEN 'class ' || name
                                          ELSE name || ' = <value>' END
         || '  (' || path || ':' || line || ':' || col || ')'
  FROM defined)
"""
)


@_query(
    _CODE
    + _BOUND
    + "SELECT repo, path, name, arg_min(target, seq) FILTER (target IS NOT NULL) AS target"
    " FROM bound GROUP BY repo, path, name"
)
def symbols(spark, sf_dir):
    return ul.symbols(_facts(spark, sf_dir)).select("repo", "path", "name", "target")


@_query(
    _CODE
    + _BOUND
    + "SELECT repo, path, name, string_agg(declaration, ';' ORDER BY seq) AS declarations"
    " FROM bound GROUP BY repo, path, name"
)
def symbol_declarations(spark, sf_dir):
    return ul.symbols(_facts(spark, sf_dir)).select(
        "repo", "path", "name", _joined("declarations", ";")
    )


@_query(
    _CODE
    + _BOUND
    + _CALLS
    + "SELECT DISTINCT c.repo, c.path, base_name AS name, target FROM called c JOIN bound b"
    " ON c.repo = b.repo AND c.path = b.path AND base_name = name"
)
def name_lookup(spark, sf_dir):
    facts = _stored_facts(spark, sf_dir)
    names = ul.calls(facts).select("repo", "path", F.col("base_name").alias("name"))
    return ul.lookup_names(names.distinct(), facts).drop("declarations")


# --- modules and the import graph ---------------------------------------------------------------


@_query(
    _CODE
    + "SELECT repo, path, replace(left(path, length(path) - 3), '/', '.') AS module FROM files"
)
def module_names(spark, sf_dir):
    files = _files(spark, sf_dir)
    return files.select("repo", "path", fn.module_name(F.col("path")).alias("module"))


@_query(
    _CODE
    + """
SELECT path, module, level,
       CASE WHEN level = 0 THEN module WHEN len(parts) < level THEN NULL
            ELSE nullif(array_to_string(list_filter(
                   list_concat(parts[1:len(parts) - level], [module]), lambda p: p IS NOT NULL),
                 '.'), '') END AS base
FROM (SELECT path, CAST(CAST(k AS INTEGER) % 5 AS INTEGER) AS level,
             CASE WHEN CAST(k AS INTEGER) % 3 > 0 THEN event_type || '.k' || k END AS module,
             string_split(replace(left(path, length(path) - 3), '/', '.'), '.') AS parts FROM e)
"""
)
def relative_base(spark, sf_dir):
    k = corpus.event_k().cast("int")
    folder = (
        F.when(F.col("event_type") == "view", "src/views/")
        .when(F.col("event_type") == "error", ".venv/lib/")
        .otherwise("pkg/")
    )
    asked = corpus.read_events(spark, sf_dir).select(
        F.concat(folder, F.lit("e"), "event_id", F.lit(".py")).alias("path"),
        F.when(k % 3 > 0, F.concat("event_type", F.lit(".k"), k)).alias("module"),
        (k % 5).alias("level"),
    )
    base = fn.relative_base(F.col("path"), F.col("module"), F.col("level"))
    return asked.withColumn("base", base)


@_query(
    _CODE
    + """
SELECT repo, replace(left(path, length(path) - 3), '/', '.') AS module, path AS file
FROM files WHERE path NOT LIKE '.%'
UNION ALL SELECT repo, 'pkg', path FROM h WHERE path = 'pkg/__init__.py'
"""
)
def module_index(spark, sf_dir):
    return ul.module_index(_files(spark, sf_dir))


@_query(_CODE + _EDGES + "SELECT * FROM edges")
def import_edges(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return edges.withColumn("imported_names", F.concat_ws(",", "imported_names"))


@_query(
    _CODE
    + _EDGES
    + "SELECT * FROM edges WHERE path = 'pkg/__init__.py' AND repo = 'repo1'"
)
def imports_of(spark, sf_dir):
    edges = ul.imports_of(_edges(spark, sf_dir), "repo1", "pkg/__init__.py")
    return edges.withColumn("imported_names", F.concat_ws(",", "imported_names"))


@_query(
    _CODE
    + _EDGES
    + "SELECT DISTINCT repo, file AS target, path AS dependent FROM edges WHERE file IS NOT NULL"
)
def dependents(spark, sf_dir):
    return ul.dependents(_edges(spark, sf_dir))


# --- resolution ---------------------------------------------------------------------------------


@_query(
    _CODE
    + _RESOLVED
    + """
SELECT DISTINCT repo, path, base_name AS name, import_module,
       import_module IS NOT NULL AS is_import, is_local AS import_is_local, defining_file
FROM resolved
UNION ALL
SELECT repo, path, 'pay', NULL, false, NULL, path FROM e WHERE event_type = 'purchase'
"""
)
def resolved_names(spark, sf_dir):
    facts = _stored_facts(spark, sf_dir)
    called = ul.calls(facts).select("repo", "path", F.col("base_name").alias("name")).distinct()
    functions = ul.definitions(facts).filter(
        (F.col("kind") == "function") & (F.col("name") == "pay")
    )
    names = called.unionByName(functions.select("repo", "path", "name"))
    return ul.resolve_names(names, facts, _files(spark, sf_dir))


@_query(
    _CODE
    + _RESOLVED
    + """
SELECT repo, path, base_name, split_part(attr_chain, '.', 1) AS attr_name, import_module,
       is_local AS import_is_local, defining_file, base_name = 'helpers' AS attr_found,
       CASE base_name WHEN 'helpers' THEN 'helpers.py' END AS attr_defining_file
FROM resolved WHERE attr_chain <> ''
"""
)
def qualified_names(spark, sf_dir):
    facts = _stored_facts(spark, sf_dir)
    names = ul.calls(facts).select(
        "repo", "path", "base_name", F.get("attr_chain", F.lit(0)).alias("attr_name")
    )
    asked = names.filter(F.col("attr_name").isNotNull())
    resolved = ul.resolve_qualified(asked, facts, _files(spark, sf_dir))
    return resolved.drop("is_import", "attr_target")


@_query(_CODE + _RESOLVED + "SELECT * FROM api WHERE is_external")
def api_calls_external(spark, sf_dir):
    return _flat_calls(ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir)))


@_query(_CODE + _RESOLVED + "SELECT * FROM api")
def api_calls_all(spark, sf_dir):
    facts, files = _stored_facts(spark, sf_dir), _files(spark, sf_dir)
    return _flat_calls(ul.collect_api_calls(facts, files, external_only=False))


@_query(
    _CODE
    + _CALLS
    + """
SELECT repo, path AS file, symbol_called, split_part(symbol_called, '.', 1) AS library,
       defining_file IS NULL AS is_external, defining_file,
       CASE base_name WHEN 'f' THEN 'viewlib.k' || k ELSE target END AS import_module,
       positional_count, keyword_args, has_varargs, has_varkw
FROM called JOIN (VALUES
    ('m', 'clicklib', NULL), ('f', NULL, NULL), ('os', 'os', NULL),
    ('helpers', 'helpers', 'helpers.py'), ('run', 'pkg.helpers.run', 'pkg/helpers.py')
  ) AS r(bound, target, defining_file) ON base_name = bound,
  LATERAL (SELECT CASE base_name WHEN 'f' THEN 'viewlib.k' || k
                  ELSE concat_ws('.', target, nullif(attr_chain, '')) END AS symbol_called)
"""
)
def api_calls_full_mode(spark, sf_dir):
    facts, files = _stored_facts(spark, sf_dir), _files(spark, sf_dir)
    return _flat_calls(ul.collect_api_calls(facts, files, external_only=False, mode="full"))


_EVENT_SQL = (
    _CODE
    + _RESOLVED
    + """
SELECT repo, repo || '/' || file AS file, symbol_called, library, is_external, defining_file,
       import_module, CAST(NULL AS VARCHAR) AS commit_hash, TIMESTAMP '2024-02-01' AS "timestamp",
       positional_count, keyword_args, has_varargs, has_varkw
FROM api WHERE is_external
"""
)


@_query(_EVENT_SQL)
def call_events(spark, sf_dir):
    found = ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir))
    return _plain_time(_flat_calls(ul.call_events(found, SCAN_TIME)))


@_query(
    _CODE
    + _RESOLVED
    + """
SELECT repo || '/' || file AS file, symbol_called, library, TIMESTAMP '2024-02-01' AS event_time,
       positional_count, keyword_args, has_varargs, has_varkw
FROM api WHERE is_external
"""
)
def call_event_messages(spark, sf_dir):
    found = ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir))
    parsed = ul.parse_events(ul.to_messages(ul.call_events(found, SCAN_TIME)))
    columns = ["file", "symbol_called", "library", "event_time", "signature_shape"]
    return _plain_time(_flat_calls(parsed.select(*columns)))


@_query(
    _CODE
    + _RESOLVED
    + """
SELECT repo || '/' || file AS file, symbol_called, TIMESTAMP '2024-02-01' AS event_time
FROM api WHERE is_external
"""
)
def event_topic(spark, sf_dir):
    """Events sent to a topic, a Parquet folder here, and read back."""
    found = ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir))
    path = scratch_path(spark, "topic")
    send_events(ul.call_events(found, SCAN_TIME), fmt="parquet", path=path)
    parsed = ul.parse_events(spark.read.parquet(path))
    return _plain_time(parsed.select("file", "symbol_called", "event_time"))


@_query(_CODE + _RESOLVED + "SELECT * FROM api WHERE is_external AND library IN ('os', 'clicklib')")
def library_filter(spark, sf_dir):
    found = ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir))
    return _flat_calls(keep_libraries(found, ["os", "clicklib"]))


@_query(_CODE + "SELECT repo, path FROM files WHERE path NOT LIKE '.venv/%' AND path LIKE '%.py'")
def path_filters(spark, sf_dir):
    return keep_paths(_files(spark, sf_dir), [".py"], [".git", ".venv", "venv", "__pycache__"])


# --- tracking -----------------------------------------------------------------------------------

# The tracked set before: no signup files. After: no click files.
_SNAPSHOTS = """
, old AS (SELECT repo, path FROM e WHERE event_type <> 'signup' UNION ALL SELECT repo, path FROM h)
, new AS (SELECT repo, path FROM e WHERE event_type <> 'click' UNION ALL SELECT repo, path FROM h)
"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = corpus.read_events(spark, sf_dir)
    old = corpus.code_sources(events.filter(F.col("event_type") != "signup"))
    new = corpus.code_sources(events.filter(F.col("event_type") != "click"))
    return old, new


@_query(
    _CODE
    + _SNAPSHOTS
    + """
SELECT *, 'removed' AS change FROM (SELECT * FROM old EXCEPT SELECT * FROM new)
UNION ALL SELECT *, 'added' FROM (SELECT * FROM new EXCEPT SELECT * FROM old)
"""
)
def file_delta(spark, sf_dir):
    return ul.file_delta(*_snapshots(spark, sf_dir))


@_query(_CODE + _SNAPSHOTS + "SELECT * FROM old UNION SELECT * FROM new")
def tracked_files(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return ul.add_tracked(old.select("repo", "path"), new.select("repo", "path"))


@_query(
    _CODE
    + _IMPORTS
    + "SELECT i.* FROM imported i JOIN e ON i.repo = e.repo AND i.path = e.path"
    " WHERE event_type = 'signup'"
)
def added_file_imports(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    facts = ul.extract_added(new, ul.file_delta(old, new))
    return ul.imports(facts).drop("is_aliased", "statement_names")


@_query(
    _CODE
    + """
SELECT repo, count(*) AS tracked_files,
       count(*) FILTER (event_type IN ('click', 'view', 'purchase', 'signup')) AS external_calls,
       count(*) FILTER (event_type = 'error') AS diagnostics,
       CAST(0 AS BIGINT) AS too_complex
FROM (SELECT repo, event_type FROM e UNION ALL SELECT repo, 'helper' FROM h) GROUP BY repo
"""
)
def scan_summary(spark, sf_dir):
    facts, files = _stored_facts(spark, sf_dir), _files(spark, sf_dir)
    return ul.scan_summary(facts, files, ul.collect_api_calls(facts, files))


@_query(_ORACLES["scan_summary"])
def scan_job(spark, sf_dir):
    sources = corpus.code_sources(_wide_events(spark, sf_dir))
    return run_scan_job(sources, scratch_path(spark, "scan"), scan_time=SCAN_TIME).summary


@_query(_CODE + _RESOLVED + "SELECT * FROM api")
def incremental_scan(spark, sf_dir):
    """A scan of files some of which are missing or differ, brought up to date with all files.

    The module that ``purchase`` files import is among the missing, so their calls change too.
    """
    path = scratch_path(spark, "incremental")
    now = corpus.code_sources(_wide_events(spark, sf_dir))
    name = F.substring_index("path", "/", -1)
    gone = (F.col("path") == "helpers.py") | name.endswith("7.py")
    other = F.when(name.endswith("3.py"), F.lit("import os\nos.getcwd()\n")).otherwise(F.col("content"))
    extra = now.filter(name.endswith("5.py")).withColumn("path", F.concat(F.lit("old/"), name))
    run_incremental_scan(now.filter(~gone).withColumn("content", other).unionByName(extra), path)
    run_incremental_scan(now, path)
    return _flat_calls(scanned_calls(spark, path).drop("line", "col"))


# --- competing imports ------------------------------------------------------------------------

# The files of ``tangled_sources``.
_TANGLED = """
WITH e AS (
  SELECT 'repo' || (user_id % 10) AS repo, event_type, json_extract_string(props, '$.k') AS k,
         event_id AS n
  FROM events),
repos AS (SELECT DISTINCT repo FROM e),
t AS (
  SELECT repo, event_type, k, n, stem || n || '.py' AS path
  FROM e JOIN (VALUES ('click', 'pkg/e'), ('view', 'lib/e'), ('purchase', 'pkg/sub/e'),
                      ('signup', 'm'), ('error', 'r')) AS s(kind, stem) ON event_type = kind)
"""


def _tangled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sources = corpus.tangled_sources(_wide_events(spark, sf_dir))
    facts = store(ul.extract_facts(sources), "tangled", ["kind"])
    return facts, ul.files(facts)


@_query(
    _TANGLED
    + """
SELECT repo, path, name, target, declared
FROM t JOIN (VALUES
  ('click', 'x', 'a', 'import a{k} as x|import b{k} as x|def x(...)'),
  ('view', '*', 'm.*', 'from m import * as *'),
  ('view', 'v', 'pkg.u', 'import pkg.u as v'),
  ('purchase', 'f', 'u.f', 'from u import f as f'),
  ('signup', 'm{n}', 'm{n}', 'import m{n} as m{n}')
) AS s(kind, bare, aim, texts) ON event_type = kind,
LATERAL (SELECT replace(bare, '{n}', n::VARCHAR) AS name,
                CASE aim WHEN 'a' THEN 'a' || k ELSE replace(aim, '{n}', n::VARCHAR) END AS target,
                replace(replace(texts, '{k}', k), '{n}', n::VARCHAR) AS declared)
UNION ALL SELECT repo, path, 'f', NULL, 'def f(...)' FROM repos, (VALUES ('pkg/u.py'), ('u.py')) AS h(path)
"""
)
def tangled_symbols(spark, sf_dir):
    """The first target wins; declarations are listed in binding order."""
    facts, _ = _tangled(spark, sf_dir)
    texts = F.filter("declarations", lambda _, i: i % 2 == 1)
    declared = F.array_join(F.transform(texts, lambda x: F.substring_index(x, "  (", 1)), "|")
    return ul.symbols(facts).select("repo", "path", "name", "target", declared.alias("declared"))


@_query(
    _TANGLED
    + """
SELECT repo, replace(replace(path, '.py', ''), '/', '.') AS module, path AS file FROM t
UNION ALL SELECT repo, 'm' || n || '.__init__', 'm' || n || '/__init__.py' FROM t
WHERE event_type = 'signup'
UNION ALL SELECT repo, module, file
FROM repos, (VALUES ('pkg.u', 'pkg/u.py'), ('u', 'u.py')) AS h(module, file)
"""
)
def tangled_modules(spark, sf_dir):
    """A module wins over a package of its name."""
    return ul.module_index(_tangled(spark, sf_dir)[1])


@_query(
    _TANGLED
    + """
SELECT repo, path, replace(replace(name, '{k}', k), '{n}', n::VARCHAR) AS module,
       replace(found, '{n}', n::VARCHAR) AS file, found IS NOT NULL AS is_local, imported_names
FROM t JOIN (VALUES
  ('click', 'a{k}', NULL, ''), ('click', 'b{k}', NULL, ''), ('view', 'm', NULL, '*'),
  ('view', 'pkg.u', 'pkg/u.py', ''), ('purchase', 'pkg.u', 'pkg/u.py', 'f'),
  ('signup', 'm{n}', 'm{n}.py', '')
) AS g(kind, name, found, imported_names) ON event_type = kind
"""
)
def tangled_edges(spark, sf_dir):
    edges = ul.import_edges(*_tangled(spark, sf_dir))
    return edges.withColumn("imported_names", F.concat_ws(",", "imported_names"))


_TANGLED_CALLS = """
SELECT repo, path AS file, replace(replace(symbol, '{k}', k), '{n}', n::VARCHAR) AS symbol_called,
       found IS NULL AS is_external, replace(found, '{n}', n::VARCHAR) AS defining_file,
       replace(replace(aim, '{k}', k), '{n}', n::VARCHAR) AS import_module
FROM t JOIN (VALUES %s) AS c(kind, symbol, found, aim) ON event_type = kind
"""


def _tangled_calls(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    found = ul.collect_api_calls(*_tangled(spark, sf_dir), external_only=False, mode=mode)
    return found.select(
        "repo", "file", "symbol_called", "is_external", "defining_file", "import_module"
    )


@_query(
    _TANGLED
    + _TANGLED_CALLS
    % """
  ('click', 'a{k}.f', NULL, 'a{k}'), ('view', 'pkg.u.go', NULL, 'pkg.u'),
  ('purchase', 'u.f', NULL, 'u.f'), ('signup', 'm{n}.go', 'm{n}.py', 'm{n}')"""
)
def tangled_calls(spark, sf_dir):
    return _tangled_calls(spark, sf_dir, "reference")


@_query(
    _TANGLED
    + _TANGLED_CALLS
    % """
  ('click', 'a{k}.f', NULL, 'a{k}'), ('view', 'pkg.u.go', 'pkg/u.py', 'pkg.u'),
  ('purchase', 'pkg.u.f', 'pkg/u.py', 'pkg.u.f'), ('signup', 'm{n}.go', 'm{n}.py', 'm{n}'),
  ('error', 'u.g', 'u.py', 'u')"""
)
def tangled_calls_full_mode(spark, sf_dir):
    return _tangled_calls(spark, sf_dir, "full")


# --- tables and loads ---------------------------------------------------------------------------


@_query(_USAGE + _MONTHS + "SELECT * FROM months")
def usage_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "usage")
    months = ul.monthly_usage(_events(spark, sf_dir))
    overwrite(months.filter("usage_count > 1"), path)
    overwrite(months, path)
    return _plain_time(read_usage(spark, path))


@_query(
    _USAGE
    + _MONTHS
    + """
SELECT repo, symbol_called, time_window, CASE WHEN symbol_called NOT LIKE 'click%' THEN usage_count
       END AS usage_count FROM months
"""
)
def parquet_parts_union(spark, sf_dir):
    path = scratch_path(spark, "parts")
    months = ul.monthly_usage(_events(spark, sf_dir))
    library = F.substring_index("symbol_called", ".", 1)
    months.filter(library == "view").withColumn("note", F.lit("extra")).write.parquet(f"{path}/part=1")
    months.filter(library == "click").drop("usage_count").write.parquet(f"{path}/part=2")
    months.filter(library == "purchase").write.parquet(f"{path}/2024/01")
    months.filter(~library.isin("view", "click", "purchase")).write.mode("append").parquet(path)
    return _plain_time(require_columns(read_parts(spark, path), USAGE.names))


@_query(
    _USAGE
    + _MONTHS
    + """
SELECT repo, symbol_called, time_window, CASE WHEN symbol_called NOT LIKE 'click%' THEN usage_count
       END AS usage_count FROM months
"""
)
def parquet_parts_widened(spark, sf_dir):
    """Parts that hold the count as a short, an int, a long, and as text without any value."""
    path = scratch_path(spark, "parts")
    months = ul.monthly_usage(_events(spark, sf_dir))
    library, count = F.substring_index("symbol_called", ".", 1), F.col("usage_count")
    for name, kind in (("view", "smallint"), ("purchase", "int"), ("signup", "bigint")):
        part = months.filter(library == name).withColumn("usage_count", count.cast(kind))
        part.write.mode("append").parquet(f"{path}/{name}")
    rest = months.filter(~library.isin("view", "purchase", "signup", "click"))
    rest.withColumn("usage_count", count.cast("int")).write.mode("append").parquet(f"{path}/signup")
    none = months.filter(library == "click").withColumn("usage_count", F.lit(None).cast("string"))
    none.write.parquet(f"{path}/click")
    return _plain_time(require_columns(read_parts(spark, path), USAGE.names))


@_query(
    _CODE
    + _RESOLVED
    + """
, months AS (
  SELECT repo, symbol_called, TIMESTAMP '2024-02-01' AS time_window, count(*) AS usage_count
  FROM api WHERE is_external GROUP BY ALL)
, listed AS (
  SELECT replace(symbol, event_type || '.', event_type || 'lib.') AS symbol, severity,
         '1.' || k AS deprecated_in
  FROM (SELECT DISTINCT event_type, CAST(k AS INTEGER) AS k FROM e),
       LATERAL (SELECT event_type || '.k' || k AS symbol, CASE WHEN k % 6 = 0 THEN 1 ELSE k % 6 END
                       AS severity), (VALUES (1), (2)) AS c(copy)
  WHERE k < 50 AND (copy = 1 OR k < 5))
SELECT repo, time_window, CAST(sum(usage_count * severity) AS BIGINT) AS exposure_score,
       CAST(sum(usage_count) AS BIGINT) AS total_deprecated_calls,
       count(DISTINCT symbol_called) AS unique_deprecated_apis
FROM months JOIN listed ON symbol_called = symbol GROUP BY ALL
"""
)
def code_to_exposure(spark, sf_dir):
    found = ul.collect_api_calls(_stored_facts(spark, sf_dir), _files(spark, sf_dir))
    events = ul.parse_events(ul.to_messages(ul.call_events(found, SCAN_TIME)))
    listed = corpus.deprecated_symbols(corpus.read_events(spark, sf_dir)).withColumn(
        "symbol", F.regexp_replace("symbol", r"\.", "lib.")
    )
    scored = ul.deprecated_usage(ul.monthly_usage(events), listed)
    return _plain_time(ul.repo_exposure(scored))
