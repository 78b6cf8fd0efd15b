"""Column expressions on paths, module names and symbols."""

from usagelens.functions.names import (
    full_symbol,
    library_of,
    module_prefix,
    month_bucket,
    month_label,
)
from usagelens.functions.paths import (
    display_path,
    module_name,
    package_name,
    relative_base,
    resolvable,
)

__all__ = [
    "display_path",
    "full_symbol",
    "library_of",
    "module_name",
    "module_prefix",
    "month_bucket",
    "month_label",
    "package_name",
    "relative_base",
    "resolvable",
]
