"""Which file an import refers to, and the graph between files that follows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import module_name, package_name, relative_base, resolvable
from usagelens.operators.extract import imports


def module_index(files: DataFrame) -> DataFrame:
    """The file each importable module of a repo lives in: repo, module, file.

    ``a/b.py`` wins over ``a/b/__init__.py``. Modules are looked up from the repo root only.
    ``files`` needs repo and path, so over a source table the text is never read. As no such path
    has other dots, a module and its rank tell the file, so files are hashed and not sorted.
    """
    path = F.col("path")
    candidates = F.array(
        F.struct(module_name(path).alias("module"), F.lit(1).alias("rank")),
        F.struct(package_name(path).alias("module"), F.lit(2).alias("rank")),
    )
    ranked = (
        files.filter(resolvable(path))
        .select("repo", F.inline(candidates))
        .filter(F.col("module").isNotNull())
        .groupBy("repo", "module")
        .agg(F.min("rank").alias("rank"))
    )
    end = F.when(F.col("rank") == 1, ".py").otherwise("/__init__.py")
    file = F.concat(F.replace("module", F.lit("."), F.lit("/")), end)
    return ranked.select("repo", "module", file.alias("file"))


def import_edges(facts: DataFrame, files: DataFrame) -> DataFrame:
    """One edge per plain import alias and per ``from`` statement with all its names.

    ``file`` is the local file the module resolves to, if any. A relative import that climbs out
    of the repo, or names nothing, has no edge. ``facts`` should be a stored table.
    """
    edges = (
        imports(facts)
        .filter(~F.col("is_from") | (F.col("alias_pos") == 0))
        .select(
            "repo",
            "path",
            relative_base(F.col("path"), F.col("module"), F.col("level")).alias("module"),
            F.coalesce("statement_names", F.array().cast("array<string>")).alias("imported_names"),
        )
        .filter(F.col("module").isNotNull())
    )
    # One module may be what a third of all rows ask for: adaptive execution splits such a key's
    # rows, of which the index has one.
    return edges.join(module_index(files), ["repo", "module"], "left").select(
        "repo",
        "path",
        "module",
        "file",
        F.col("file").isNotNull().alias("is_local"),
        "imported_names",
    )


def imports_of(edges: DataFrame, repo: str, path: str) -> DataFrame:
    """The edges leaving one file."""
    return edges.filter((F.col("repo") == repo) & (F.col("path") == path))


def dependents(edges: DataFrame, repo: str | None = None, target: str | None = None) -> DataFrame:
    """Files that import a local file, each once per target; optionally of one target only."""
    found = edges.filter(F.col("file").isNotNull())
    if repo is not None:
        found = found.filter(F.col("repo") == repo)
    if target is not None:
        found = found.filter(F.col("file") == target)
    return found.select(
        "repo", F.col("file").alias("target"), F.col("path").alias("dependent")
    ).distinct()


def moved_modules(old_files: DataFrame, new_files: DataFrame) -> DataFrame:
    """Modules that another file, or none, or a first one, stands for now: repo, module."""
    old, new = (module_index(f) for f in (old_files, new_files))
    both = old.withColumnRenamed("file", "_old").join(new, ["repo", "module"], "full")
    return both.filter(~F.col("_old").eqNullSafe(F.col("file"))).select("repo", "module")


def imported_modules(facts: DataFrame) -> DataFrame:
    """Every module an import of a file may be looked up by, in either mode: repo, path, module."""
    path, module, level = F.col("path"), F.col("module"), F.col("level")
    base = relative_base(path, module, level, with_root=True)
    submodule = F.concat_ws(".", F.nullif(base, F.lit("")), "name")
    names = F.when(F.col("is_from"), F.array(base, submodule)).otherwise(F.array(base, module))
    exploded = imports(facts).select("repo", "path", F.explode(names).alias("module"))
    return exploded.filter("module <> ''").distinct()


def importers(facts: DataFrame, modules: DataFrame) -> DataFrame:
    """The files whose imports may be looked up by one of ``modules``: repo, path."""
    found = imported_modules(facts).join(modules, ["repo", "module"], "left_semi")
    return found.select("repo", "path").distinct()
