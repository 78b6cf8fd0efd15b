"""Readers for source code, usage tables, the deprecated list and message topics."""

from usagelens.sources.code import keep_libraries, keep_paths, read_code
from usagelens.sources.folders import code_changes, code_folders
from usagelens.sources.messages import read_topic
from usagelens.sources.tables import read_deprecated, read_parts, read_usage

__all__ = [
    "code_changes",
    "code_folders",
    "keep_libraries",
    "keep_paths",
    "read_code",
    "read_deprecated",
    "read_parts",
    "read_topic",
    "read_usage",
]
