"""Scan job: source table in, call events and a per-repo summary out."""

import datetime
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from usagelens.operators.events import call_events
from usagelens.operators.extract import diagnostics, extract_facts
from usagelens.operators.extract import files as files_of
from usagelens.operators.resolve import collect_api_calls
from usagelens.operators.tracking import scan_summary
from usagelens.sinks.messages import send_events
from usagelens.sources.code import keep_libraries
from usagelens.storage import store


class Scan(NamedTuple):
    events: DataFrame
    summary: DataFrame
    diagnostics: DataFrame


def run_scan_job(
    sources: DataFrame,
    work_path: str,
    mode: str = "reference",
    scan_time: datetime.datetime | None = None,
    send: bool = False,
    fmt: str = "kafka",
    target_libraries: Sequence[str] = (),
    **topic: str,
) -> Scan:
    """Scan ``sources`` and, with ``send``, write the external calls found to a topic.

    The source table is read once, and ``target_libraries`` limit the calls kept if any are named.
    Facts and events are stored under ``work_path``, a folder all executors
    share, so sending and the summary read them instead of parsing or resolving again.
    """
    facts = store(extract_facts(sources), "facts", ["kind"], f"{work_path}/facts")
    files = files_of(facts)
    found = collect_api_calls(facts, files, external_only=True, mode=mode, with_place=True)
    found = keep_libraries(found, target_libraries)
    now = scan_time or datetime.datetime.now(datetime.timezone.utc)
    events = store(call_events(found, now), "events", path=f"{work_path}/events")
    send_events(events, send, fmt, **topic)
    return Scan(events, scan_summary(facts, files, events), diagnostics(facts))
