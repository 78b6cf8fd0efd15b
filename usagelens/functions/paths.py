"""Column expressions that map file paths to module names.

They use plain string functions only: these run for every import, where patterns would dominate.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_path(repo: Column, path: Column) -> Column:
    """``repo/relative/path``, the file label events carry."""
    return F.concat_ws("/", repo, path)


def is_module_file(path: Column) -> Column:
    """Whether a path is a ``.py`` file that has a name before its extension."""
    return path.endswith(".py") & ~path.endswith("/.py") & (path != ".py")


def module_name(path: Column) -> Column:
    """Dotted module name of a repo-relative path; null unless it is a named ``.py`` file."""
    return F.when(is_module_file(path), _dotted(_without_end(path, ".py")))


def package_name(path: Column) -> Column:
    """Dotted name of the package an ``__init__.py`` stands for; null for other files."""
    init = "/__init__.py"
    return F.when(path.endswith(init), _dotted(_without_end(path, init)))


def resolvable(path: Column) -> Column:
    """Whether an import can name this file: no dots in its folders or stem."""
    return path.endswith(".py") & (F.instr(path, ".") == F.length(path) - 2)


def relative_base(
    path: Column, module: Column, level: Column, with_root: bool = False
) -> Column:
    """Module a ``from`` import at ``level`` refers to, seen from the file at ``path``.

    Level 0 is absolute. Otherwise the file's own name and ``level - 1`` packages are dropped and
    ``module`` is appended; climbing past the root gives null. So does ending with no name, at the
    root itself, unless ``with_root`` makes that an empty text.
    """
    dotted = _dotted(path)
    # Of "a.b.file.py" the name and the extension go at level 1, and one package per level more.
    kept = F.length(dotted) - F.length(F.replace(dotted, F.lit("."))) - level
    package = F.when(kept > 0, F.call_function("substring_index", dotted, F.lit("."), kept))
    base = F.concat_ws(".", package, F.nullif(module, F.lit("")))
    return (
        F.when(level == 0, F.nullif(module, F.lit("")))
        .when(is_module_file(path) & (kept >= 0), base if with_root else F.nullif(base, F.lit("")))
    )


def _dotted(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("."))


def _without_end(path: Column, end: str) -> Column:
    return F.left(path, F.length(path) - len(end))
