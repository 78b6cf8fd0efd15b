"""Table contracts: one StructType per table the engine reads or writes."""

from pyspark.sql import types as T

_s, _i, _l, _b, _ts = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)
_names = T.ArrayType(T.StringType())


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SIGNATURE = _table(positional_count=_i, keyword_args=_names, has_varargs=_b, has_varkw=_b)

# ``content`` may also be binary; undecodable bytes then become a diagnostic.
SOURCES = T.StructType(
    [
        T.StructField("repo", _s, False),
        T.StructField("path", _s, False),
        T.StructField("content", _s, True),
    ]
)

# One row per import alias, definition, call or diagnostic; ``kind`` tells which.
FACTS = _table(
    repo=_s,
    path=_s,
    kind=_s,
    seq=_i,
    line=_i,
    col=_i,
    alias_pos=_i,
    is_from=_b,
    module=_s,
    level=_i,
    name=_s,
    local_name=_s,
    is_aliased=_b,
    statement_names=_names,
    definition_kind=_s,
    base_name=_s,
    attr_chain=_names,
    signature_shape=SIGNATURE,
    message=_s,
)

# A message as either producer spells it; ``parse_events`` folds the pairs.
EVENT_MESSAGE = _table(
    repo=_s,
    repo_name=_s,
    file=_s,
    file_path=_s,
    symbol_called=_s,
    call_full_name=_s,
    symbol=_s,
    library=_s,
    signature_shape=SIGNATURE,
    is_external=_b,
    defining_file=_s,
    import_module=_s,
    commit_hash=_s,
    event_id=_s,
    timestamp=_ts,
    event_time=_ts,
)

# Resolved calls as scans keep them, with the place of each in its file.
API_CALLS = _table(
    repo=_s,
    file=_s,
    line=_i,
    col=_i,
    symbol_called=_s,
    library=_s,
    signature_shape=SIGNATURE,
    is_external=_b,
    defining_file=_s,
    import_module=_s,
)

# The files a scan has seen: a hash of each text, and the generations that hold its facts and calls.
SCANNED = _table(repo=_s, path=_s, version=_l, size=_l, facts_gen=_i, calls_gen=_i)

USAGE_DAILY = _table(library=_s, symbol=_s, num_calls=_l, event_day_start=_ts, event_day_end=_ts)

REPO_USAGE_DAILY = _table(
    repo=_s,
    library=_s,
    symbol=_s,
    symbol_called=_s,
    num_calls=_l,
    event_day_start=_ts,
    event_day_end=_ts,
)

USAGE = _table(repo=_s, symbol_called=_s, time_window=_ts, usage_count=_l)

DEPRECATED_APIS = _table(
    symbol=_s, library=_s, deprecated_in=_s, removed_in=_s, severity=_i, replacement=_s
)

DEPRECATED_USAGE = _table(
    repo=_s,
    symbol_called=_s,
    time_window=_ts,
    usage_count=_l,
    deprecated_in=_s,
    removed_in=_s,
    severity=_i,
    replacement=_s,
    exposure_score=_l,
)

REPO_EXPOSURE = _table(
    repo=_s,
    time_window=_ts,
    exposure_score=_l,
    total_deprecated_calls=_l,
    unique_deprecated_apis=_l,
)
