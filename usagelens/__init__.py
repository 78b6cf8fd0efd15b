"""Library-usage analytics on Spark: from source code to deprecation exposure."""

from usagelens.operators.bindings import bindings, lookup_names, symbols
from usagelens.operators.events import call_events, parse_events, to_messages
from usagelens.operators.exposure import deprecated_usage, repeated_symbols, repo_exposure
from usagelens.operators.extract import (
    balance,
    calls,
    definitions,
    diagnostics,
    extract_facts,
    files,
    imports,
    widen,
)
from usagelens.operators.import_graph import (
    dependents,
    import_edges,
    importers,
    imports_of,
    module_index,
    moved_modules,
)
from usagelens.operators.resolve import collect_api_calls, resolve_names, resolve_qualified
from usagelens.operators.tracking import (
    add_tracked,
    content_delta,
    extract_added,
    extract_single,
    file_delta,
    scan_summary,
    versions,
)
from usagelens.operators.usage import daily_usage, library_days, monthly_usage, months_of_days

__all__ = [
    "add_tracked",
    "balance",
    "bindings",
    "call_events",
    "calls",
    "collect_api_calls",
    "content_delta",
    "daily_usage",
    "definitions",
    "dependents",
    "deprecated_usage",
    "diagnostics",
    "extract_added",
    "extract_facts",
    "extract_single",
    "files",
    "file_delta",
    "import_edges",
    "importers",
    "imports",
    "imports_of",
    "library_days",
    "lookup_names",
    "module_index",
    "monthly_usage",
    "months_of_days",
    "moved_modules",
    "parse_events",
    "repeated_symbols",
    "repo_exposure",
    "resolve_names",
    "resolve_qualified",
    "scan_summary",
    "symbols",
    "to_messages",
    "versions",
    "widen",
]
