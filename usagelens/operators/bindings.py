"""Which names a file binds, and to what."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bindings(facts: DataFrame) -> DataFrame:
    """Every binding of a module-level name, numbered in binding order within its file.

    Imports come first in source order, then definitions. ``target`` is what an import refers to
    as written, without its relative level; definitions have none. A relative import that names
    no module binds nothing.
    """
    is_import = F.col("kind") == "import"
    is_definition = F.col("kind") == "definition"
    bound = facts.filter((is_import & F.col("module").isNotNull()) | is_definition)
    return bound.select(
        "repo",
        "path",
        F.coalesce("local_name", "name").alias("name"),
        "seq",
        F.coalesce("definition_kind", "kind").alias("kind"),
        F.when(is_import, F.concat_ws(".", "module", "name")).alias("target"),
        F.when(is_import, _import_text()).otherwise(_definition_text()).alias("declaration"),
    )


def symbols(facts: DataFrame) -> DataFrame:
    """The symbol table: one row per name a file binds.

    The first import to bind a name gives its target, whatever follows. ``declarations`` lists a
    kind tag and a description for every binding, in order. Groups never exceed one file.
    """
    described = F.struct("seq", F.concat(F.lit("<"), "kind", F.lit(">")).alias("tag"), "declaration")
    return (
        bindings(facts)
        .groupBy("repo", "path", "name")
        .agg(
            F.min_by("target", F.when(F.col("target").isNotNull(), F.col("seq"))).alias("target"),
            F.sort_array(F.collect_list(described)).alias("_described"),
        )
        .select(
            "repo",
            "path",
            "name",
            "target",
            F.flatten(
                F.transform("_described", lambda d: F.array(d["tag"], d["declaration"]))
            ).alias("declarations"),
        )
    )


def lookup_names(names: DataFrame, facts: DataFrame) -> DataFrame:
    """The symbol each (repo, path, name) in ``names`` refers to; unbound names are dropped.

    Only module-level names are ever bound, so builtins and local variables find nothing.
    """
    return names.join(symbols(facts), ["repo", "path", "name"])


# How declarations read, and where they say they are.
_FROM_IMPORT = "from %s import %s as %s"
_PLAIN_IMPORT = "import %s as %s"
_FUNCTION = "def %s(...)"
_CLASS = "class %s"
_VARIABLE = "%s = <value>"
_AT_OFFSET = "%s  (%s @ offset %d)"
_AT_LINE = "%s  (%s:%d:%d)"


def _import_text() -> Column:
    text = F.when(
        F.col("is_from"), F.format_string(_FROM_IMPORT, "module", "name", "local_name")
    ).otherwise(F.format_string(_PLAIN_IMPORT, "module", "local_name"))
    return F.format_string(_AT_OFFSET, text, "path", "line")


def _definition_text() -> Column:
    kind = F.col("definition_kind")
    text = (
        F.when(kind == "function", F.format_string(_FUNCTION, "name"))
        .when(kind == "class", F.format_string(_CLASS, "name"))
        .otherwise(F.format_string(_VARIABLE, "name"))
    )
    return F.format_string(_AT_LINE, text, "path", "line", "col")
