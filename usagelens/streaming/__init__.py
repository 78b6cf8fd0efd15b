"""The usage stream."""

from usagelens.streaming.exposure import exposure_stream, write_scores
from usagelens.streaming.usage import (
    StreamCounts,
    compact_days,
    daily_usage_stream,
    finish,
    read_days,
    write_days,
)

__all__ = [
    "StreamCounts",
    "compact_days",
    "daily_usage_stream",
    "exposure_stream",
    "finish",
    "read_days",
    "write_days",
    "write_scores",
]
