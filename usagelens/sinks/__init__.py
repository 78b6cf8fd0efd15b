"""Writers for messages, result tables and SQL databases."""

from usagelens.sinks.database import jdbc_options, load_table
from usagelens.sinks.messages import send_events
from usagelens.sinks.tables import overwrite, require_columns

__all__ = ["jdbc_options", "load_table", "overwrite", "require_columns", "send_events"]
