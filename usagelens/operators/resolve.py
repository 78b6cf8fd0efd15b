"""What the names used in a file refer to, and which calls leave the repo."""

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from usagelens.functions import full_symbol, library_of, module_prefix, relative_base
from usagelens.operators.bindings import bindings, symbols
from usagelens.operators.extract import calls, imports
from usagelens.operators.import_graph import import_edges, module_index

MODES = ("reference", "full")


def resolve_names(
    names: DataFrame, facts: DataFrame, files: DataFrame, mode: str = "reference"
) -> DataFrame:
    """Resolve each (repo, path, name) row of ``names``; unbound names are dropped.

    Adds ``import_module`` (what the import refers to), ``is_import``, ``import_is_local`` (null
    when the name is no import, or no import edge of the file matches) and ``defining_file``.

    ``mode="reference"`` finds the edge by the import's target up to its last dot, as written, so
    dotted plain imports and relative imports inside packages find none. ``mode="full"`` keeps
    each import with the module it resolves to: relative levels count, ``import a.b`` binds ``a``
    but resolves ``a.b``, and ``from p import m`` is local if ``p.m`` or ``p`` is.

    Names, bindings and edges of a file are brought together by one shuffle on (repo, path); both
    lookups are windows within it. ``facts`` should be a stored table.
    """
    return _resolve(names, *_bound_and_edges(facts, files, mode))


def _bound_and_edges(
    facts: DataFrame, files: DataFrame, mode: str
) -> tuple[DataFrame, DataFrame | None]:
    """What names are bound to, and the edges to match targets with unless bindings have theirs."""
    if mode == "full":
        return _located_bindings(facts, files), None
    if mode != "reference":
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    bound = bindings(facts).select(
        "repo", "path", "name", F.col("target").alias("_target"), F.col("seq").alias("_rank")
    )
    edges = import_edges(facts, files).select(
        "repo", "path", F.col("module").alias("_module"), F.col("file").alias("_file")
    )
    return bound, edges


def _resolve(names: DataFrame, bound: DataFrame, edges: DataFrame | None) -> DataFrame:
    own = names.columns
    rows = names.withColumn("_role", F.lit("use")).unionByName(
        bound.withColumn("_role", F.lit("binding")), allowMissingColumns=True
    )
    if edges is not None:
        rows = rows.unionByName(
            edges.withColumn("_role", F.lit("edge")), allowMissingColumns=True
        )
    role = F.col("_role")

    by_name = _within_file("name")
    found = [c for c in ("_target", "_known", "_file") if c in bound.columns]
    rank = F.when(F.col("_target").isNotNull(), F.col("_rank"))
    first = F.min_by(F.struct(*found), rank).over(by_name)
    is_bound = F.max(role == "binding").over(by_name)
    rows = rows.repartition("repo", "path").withColumns({"_first": first, "_bound": is_bound})
    rows = rows.withColumn("import_module", F.col("_first._target"))
    is_use = (role == "use") & F.col("_bound")
    if edges is None:
        rows = rows.withColumns({"_known": F.col("_first._known"), "_found": F.col("_first._file")})
    else:
        rows = rows.filter(is_use | (role == "edge"))
        rows = rows.withColumn(
            "_module", F.coalesce("_module", module_prefix(F.col("import_module")))
        )
        by_module = _within_file("_module")
        known, file = F.max(role == "edge").over(by_module), F.max("_file").over(by_module)
        rows = rows.withColumns({"_known": known, "_found": file})

    is_import = F.col("import_module").isNotNull()
    return rows.filter(is_use).select(
        *own,
        "import_module",
        is_import.alias("is_import"),
        F.when(is_import & F.col("_known"), F.col("_found").isNotNull()).alias("import_is_local"),
        F.when(is_import, F.col("_found")).otherwise(F.col("path")).alias("defining_file"),
    )


def _within_file(column: str) -> WindowSpec:
    """A window per file and ``column``, led by a hash: paths share long prefixes, and sorting
    compares the hash first.
    """
    keys = ["repo", "path", column]
    return Window.partitionBy(F.xxhash64(*keys), *keys)


def _located_bindings(facts: DataFrame, files: DataFrame) -> DataFrame:
    """Bindings that carry the file their own import resolves to.

    A ``from`` import is listed once per module it may mean, the submodule before the package; the
    rank puts a candidate that resolves ahead of one that does not.
    """
    base = relative_base(F.col("path"), F.col("module"), F.col("level"), with_root=True)
    named = F.nullif(base, F.lit(""))
    prefix = F.when(
        F.col("is_from"), F.concat_ws(".", F.coalesce(named, F.col("module")), F.col("name"))
    ).otherwise(
        F.when(F.col("is_aliased"), F.col("module")).otherwise(F.col("local_name"))
    )
    modules = F.when(F.col("is_from"), F.array(F.concat_ws(".", named, "name"), base)).otherwise(
        F.array("module")
    )
    located = (
        imports(facts)
        .filter(base.isNotNull())
        .select(
            "repo",
            "path",
            "seq",
            F.col("local_name").alias("name"),
            prefix.alias("_target"),
            F.posexplode(modules).alias("_choice", "module"),
        )
    )
    located = located.join(module_index(files), ["repo", "module"], "left").select(
        "repo",
        "path",
        "name",
        "_target",
        F.lit(True).alias("_known"),
        F.col("file").alias("_file"),
        F.struct("seq", F.col("file").isNull().alias("missing"), "_choice").alias("_rank"),
    )
    # Imports that reach outside the repo bind their name but match no module.
    unplaced = (
        imports(facts)
        .filter(base.isNull() & F.col("module").isNotNull())
        .select("repo", "path", F.col("local_name").alias("name"), prefix.alias("_target"), "seq")
    )
    defined = bindings(facts).filter(F.col("kind") != "import").select(
        "repo", "path", "name", F.col("target").alias("_target"), "seq"
    )
    others = unplaced.unionByName(defined).select(
        "repo",
        "path",
        "name",
        "_target",
        F.lit(False).alias("_known"),
        F.lit(None).cast("string").alias("_file"),
        F.struct("seq", F.lit(True).alias("missing"), F.lit(0).alias("_choice")).alias("_rank"),
    )
    return located.unionByName(others)


def resolve_qualified(
    names: DataFrame, facts: DataFrame, files: DataFrame, mode: str = "reference"
) -> DataFrame:
    """Resolve ``base_name.attr_name`` rows: the base as above, the attribute in its local file.

    Adds the columns of ``resolve_names`` plus ``attr_found``, ``attr_target`` and
    ``attr_defining_file``; the attribute of anything but a local import is not looked up.
    """
    base = resolve_names(names.withColumn("name", F.col("base_name")), facts, files, mode)
    # What is not looked up keeps a key that no file has, so those rows stay spread out.
    nowhere = F.concat(F.lit("\0"), F.col("path"))
    base = base.drop("name").withColumn(
        "_file", F.when(F.col("import_is_local"), F.col("defining_file")).otherwise(nowhere)
    )
    attributes = symbols(facts).select(
        "repo",
        F.col("path").alias("_file"),
        F.col("name").alias("attr_name"),
        F.lit(True).alias("_found"),
        F.col("target").alias("attr_target"),
    )
    looked_up = base.join(attributes, ["repo", "_file", "attr_name"], "left")
    return looked_up.select(
        *[c for c in base.columns if c != "_file"],
        F.coalesce("_found", F.lit(False)).alias("attr_found"),
        "attr_target",
        F.when(F.col("_found"), F.col("defining_file")).alias("attr_defining_file"),
    )


def collect_api_calls(
    facts: DataFrame,
    files: DataFrame,
    external_only: bool = True,
    mode: str = "reference",
    with_place: bool = False,
) -> DataFrame:
    """One record per call whose callee resolves; by default only those that leave the repo.

    External means bound by an import that is not known to be local, the standard library
    included. ``facts`` should be a stored table; ``files`` needs repo and path only.
    ``with_place`` adds the line and column of the call, of which a file has one call each.
    """
    place = ["line", "col"] if with_place else []
    used = calls(facts).withColumnRenamed("base_name", "name")
    bound, edges = _bound_and_edges(facts, files, mode)
    if external_only:
        # Only imports can make a call external.
        bound = bound.filter(F.col("_target").isNotNull())
    if edges is not None:
        # An edge without a file says no more than no edge: the call is external either way.
        edges = edges.filter(F.col("_file").isNotNull())
    resolved = _resolve(used, bound, edges).select(
        "repo",
        F.col("path").alias("file"),
        *place,
        full_symbol(F.col("import_module"), F.col("name"), F.col("attr_chain")).alias("symbol_called"),
        "signature_shape",
        (F.col("is_import") & ~F.coalesce("import_is_local", F.lit(False))).alias("is_external"),
        "defining_file",
        "import_module",
    )
    if external_only:
        resolved = resolved.filter("is_external")
    return resolved.select(
        "repo",
        "file",
        *place,
        "symbol_called",
        library_of(F.col("symbol_called")).alias("library"),
        "signature_shape",
        "is_external",
        "defining_file",
        "import_module",
    )
