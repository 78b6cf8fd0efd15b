"""Code facts from source text: one parse per file, spread over the cluster.

This is the only Python in the engine. It turns a file into flat rows and nothing more; binding and
resolution are joins over those rows.
"""

import ast
import heapq
import sys
import warnings
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from usagelens.schemas import FACTS

# Ship the worker code inside the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FACTS_ARROW = to_arrow_schema(FACTS)
_ROWS_PER_BATCH = 20_000
_SLOTS = 32

# Fixed value: how the diagnostic of anything but a syntax error starts.
_OTHER_FAILURE = "Unexpected error while parsing: "

# What the parser says of source that is nested too deeply for it.
_TOO_COMPLEX = "Parser stack overflowed"
_TOO_DEEP = "maximum recursion depth exceeded"

# The columns each kind of fact fills; the others are null.
_FILLED = {
    "import": (
        "repo",
        "path",
        "seq",
        "line",
        "col",
        "alias_pos",
        "is_from",
        "module",
        "level",
        "name",
        "local_name",
        "is_aliased",
        "statement_names",
    ),
    "definition": ("repo", "path", "seq", "line", "col", "definition_kind", "name"),
    "call": ("repo", "path", "line", "col", "base_name", "attr_chain", "signature_shape"),
    "diagnostic": ("repo", "path", "line", "col", "message"),
    "file": ("repo", "path"),
}

# Stands for the path while a text is parsed, as files with equal texts are parsed once.
_ANY_PATH = "source.py"


# Fields of syntax nodes that never have calls or imports below them.
_BARE = {"arg", "asname", "attr", "ctx", "id", "kind", "level", "lineno", "module", "name", "names"}
_BARE |= {"op", "ops", "tag", "type_comment"}

# The fields to follow from each type of node; a constant's value is no node.
_CHILDREN = {
    node: tuple(field for field in node._fields if field not in _BARE)
    for node in vars(ast).values()
    if isinstance(node, type) and issubclass(node, ast.AST) and not issubclass(node, ast.Constant)
}


def extract_facts(sources: DataFrame) -> DataFrame:
    """Imports, definitions, calls and diagnostics of every file in ``sources``, and the file itself.

    ``sources`` holds repo, path and content (text or bytes). A file that cannot be decoded or
    parsed gives one diagnostic and nothing else but itself. Facts feed several steps, so jobs store them
    (``usagelens.storage.store``) before resolving names.
    """
    return sources.select("repo", "path", "content").mapInArrow(_facts_of_batches, FACTS)


def widen(sources: DataFrame, tasks: int) -> DataFrame:
    """Spread sources that are read as fewer splits than the cluster has cores over ``tasks`` tasks.

    Parsing is CPU-bound, so a small input read as one split would keep one core busy. This moves
    the texts, so leave a table alone that has splits enough.
    """
    return sources.repartition(tasks)


def balance(sources: DataFrame, tasks: int, per_task: int = 64) -> DataFrame:
    """Spread sources over ``tasks`` tasks by the bytes of their contents, not by their number.

    A task gets about the mean number of bytes, or one file that alone has more. Files that are
    large beside the mean, ``tasks * per_task`` of them at most, are dealt one by one, the largest
    first, each to the task with least so far; the many others by hash, to each task in the
    proportion of what it has left. Contents are read once to be measured and once to be moved.
    """
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")
    sizes = sources.select("repo", "path", size.alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    mean = total / tasks
    large = sizes.filter(F.col("size") > mean / per_task).orderBy(F.desc("size"), "repo", "path")
    dealt = [(0, task) for task in range(tasks)]
    places = []
    for row in large.limit(tasks * per_task).collect():  # no more can be that large
        load, task = heapq.heappop(dealt)
        heapq.heappush(dealt, (load + row["size"], task))
        places.append((row["repo"], row["path"], task))
    left = {task: max(0.0, mean - load) for load, task in dealt}
    rest = sum(left.values()) or 1.0
    slots = [t for t, spare in sorted(left.items()) for _ in range(round(_SLOTS * tasks * spare / rest))]
    slots = slots or list(range(tasks))
    spark = sources.sparkSession
    placed = spark.createDataFrame(places, "repo string, path string, _task int")
    hashed = F.pmod(F.xxhash64("repo", "path"), F.lit(len(slots))).cast("int")
    task = F.coalesce("_task", F.get(F.lit(slots), hashed))
    return (
        sources.join(F.broadcast(placed), ["repo", "path"], "left")
        .withColumn("_task", task)
        .repartitionById(tasks, "_task")
        .select(*sources.columns)
    )


def files(facts: DataFrame) -> DataFrame:
    """The repo and path of every file read, parsed or not."""
    return facts.filter(F.col("kind") == "file").select("repo", "path")


def imports(facts: DataFrame) -> DataFrame:
    """One row per import alias."""
    return facts.filter(F.col("kind") == "import").select(
        "repo",
        "path",
        "seq",
        "line",
        "col",
        "alias_pos",
        "is_from",
        "module",
        "level",
        "name",
        "local_name",
        "is_aliased",
        "statement_names",
    )


def definitions(facts: DataFrame) -> DataFrame:
    """Module-level functions, classes and variables."""
    return facts.filter(F.col("kind") == "definition").select(
        "repo", "path", "seq", "line", "col", F.col("definition_kind").alias("kind"), "name"
    )


def calls(facts: DataFrame) -> DataFrame:
    """Calls whose callee is a plain name or an attribute chain on one."""
    return facts.filter(F.col("kind") == "call").select(
        "repo", "path", "line", "col", "base_name", "attr_chain", "signature_shape"
    )


def diagnostics(facts: DataFrame) -> DataFrame:
    """Files that could not be parsed, with the reason and its place."""
    return facts.filter(F.col("kind") == "diagnostic").select(
        "repo", "path", "message", "line", F.col("col").alias("column")
    )


def is_too_complex(message: Column) -> Column:
    """Whether a diagnostic is of valid or invalid source nested too deeply for the parser."""
    said = [F.lit(_OTHER_FAILURE + limit) for limit in (_TOO_COMPLEX, _TOO_DEEP)]
    return F.startswith(message, said[0]) | F.startswith(message, said[1])


def _facts_of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct text of a batch is parsed once; its facts are then given to all its files."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for batch in batches:
            repos, paths, contents = (batch.column(i) for i in range(3))
            coded = contents.dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            found, lengths, n_rows, first = {kind: [] for kind in _FILLED}, [], 0, 0
            for text in coded.dictionary:
                before = {kind: len(rows) for kind, rows in found.items()}
                for kind, *values in _facts_of_file(_ANY_PATH, text.as_py()):
                    found[kind].append(values)
                    n_rows += 1
                lengths.append([len(found[kind]) - n for kind, n in before.items()])
                if n_rows >= _ROWS_PER_BATCH:
                    yield from _give(repos, paths, codes, order, first, lengths, found)
                    first += len(lengths)
                    found, lengths, n_rows = {kind: [] for kind in _FILLED}, [], 0
            if lengths:
                yield from _give(repos, paths, codes, order, first, lengths, found)


def _give(
    repos: pa.Array,
    paths: pa.Array,
    codes: np.ndarray,
    order: np.ndarray,
    first: int,
    lengths: list[list[int]],
    found: dict[str, list[list]],
) -> Iterator[pa.RecordBatch]:
    """The facts ``found`` in texts from the code ``first`` on, once for each file of a text.

    ``lengths`` has the number of facts of each kind by text; ``order`` lists the files by code.
    """
    ends = np.searchsorted(codes, [first, first + len(lengths)], sorter=order)
    files = order[ends[0] : ends[1]]
    texts = codes[files] - first
    for (kind, values), n_of_text in zip(found.items(), np.array(lengths).T):
        columns = {
            name: pa.array(column, _FACTS_ARROW.field(name).type) if name != "message" else column
            for name, column in zip(_FILLED[kind][2:], zip(*values))
        }
        begin = np.cumsum(n_of_text) - n_of_text
        n = n_of_text[texts]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        for start in range(0, total, _ROWS_PER_BATCH):
            rows = np.arange(start, min(start + _ROWS_PER_BATCH, total))
            file = np.searchsorted(end, rows, side="right")
            fact = begin[texts[file]] + rows - (end[file] - n[file])
            path = paths.take(pa.array(files[file]))
            filled = {"repo": repos.take(pa.array(files[file])), "path": path}
            for name, column in columns.items():
                if name == "message":
                    said = [_said(column[i], p) for i, p in zip(fact.tolist(), path.to_pylist())]
                    filled[name] = pa.array(said, pa.string())
                else:
                    filled[name] = column.take(pa.array(fact))
            yield _to_arrow(kind, filled, len(rows))


def _to_arrow(kind: str, filled: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    filled["kind"] = pa.repeat(pa.scalar(kind, _FACTS_ARROW.field("kind").type), n)
    arrays = [
        filled[field.name].cast(field.type) if field.name in filled else pa.nulls(n, field.type)
        for field in _FACTS_ARROW
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_FACTS_ARROW)


def _facts_of_file(path: str, content: str | bytes | None) -> Iterator[tuple]:
    """Tuples of a kind and the values of its columns after repo and path.

    The message of a syntax error is the error itself, as its text names the file.
    """
    yield ("file",)
    try:
        text = content.decode("utf-8") if isinstance(content, bytes) else content or ""
        tree = ast.parse(text, filename=path)
    except SyntaxError as error:
        yield "diagnostic", error.lineno or 0, error.offset or 0, error.with_traceback(None)
        return
    except (ValueError, RecursionError) as error:  # undecodable, null bytes, nested too deeply
        yield "diagnostic", 0, 0, _plain(_OTHER_FAILURE + str(error))
        return
    except MemoryError as error:
        # The parser's own limit. A worker short of memory fails its task instead, so that what a
        # file gives does not depend on the worker.
        if not str(error).startswith(_TOO_COMPLEX):
            raise
        yield "diagnostic", 0, 0, _OTHER_FAILURE + str(error)
        return

    statements = []
    unseen = [tree]
    while unseen:
        node = unseen.pop()
        if isinstance(node, ast.Call):
            yield from _call_fact(node)
        elif isinstance(node, (ast.Import, ast.ImportFrom)):
            statements.append(node)
        for field in _CHILDREN.get(type(node), ()):
            value = getattr(node, field)
            if isinstance(value, list):
                unseen += value
            elif value is not None:
                unseen.append(value)

    # Binding order within the file: imports in source order, then definitions.
    statements.sort(key=lambda node: (node.lineno, node.col_offset))
    seq = 0
    for node in statements:
        for values in _import_values(node):
            yield "import", seq, node.lineno, node.col_offset, *values
            seq += 1
    for node in tree.body:
        for values in _definition_values(node):
            yield "definition", seq, node.lineno, node.col_offset, *values
            seq += 1


def _said(message: str | SyntaxError, path: str) -> str:
    """A diagnostic's text for the file at ``path``."""
    if isinstance(message, str):
        return message
    if message.filename is not None:
        message.filename = path
    return _plain(str(message))


def _plain(message: str) -> str:
    # A message may quote unpaired surrogates from the file, which Arrow text cannot hold.
    return message.encode("utf-8", "replace").decode("utf-8")


def _import_values(node: ast.Import | ast.ImportFrom) -> Iterator[tuple]:
    for pos, alias in enumerate(node.names):
        aliased = alias.asname is not None
        if isinstance(node, ast.ImportFrom):
            local = alias.asname or alias.name
            # The first alias carries the whole statement, so edges need no regrouping.
            names = [a.name for a in node.names] if pos == 0 else None
            yield pos, True, node.module, node.level, alias.name, local, aliased, names
        else:
            local = alias.asname or alias.name.partition(".")[0]
            yield pos, False, alias.name, 0, None, local, aliased, None


def _definition_values(node: ast.stmt) -> Iterator[tuple]:
    match node:
        case ast.FunctionDef() | ast.AsyncFunctionDef():
            yield "function", node.name
        case ast.ClassDef():
            yield "class", node.name
        case ast.Assign():
            for target in node.targets:
                if isinstance(target, ast.Name):
                    yield "variable", target.id
        case ast.AnnAssign(target=ast.Name()):
            yield "variable", node.target.id


def _call_fact(node: ast.Call) -> Iterator[tuple]:
    attrs, root = [], node.func
    while isinstance(root, ast.Attribute):
        attrs.append(root.attr)
        root = root.value
    if isinstance(root, ast.Name):
        positional = sum(not isinstance(arg, ast.Starred) for arg in node.args)
        keywords = [keyword.arg for keyword in node.keywords]
        shape = {
            "positional_count": positional,
            "keyword_args": sorted(name for name in keywords if name is not None),
            "has_varargs": positional < len(node.args),
            "has_varkw": None in keywords,
        }
        yield "call", node.lineno, node.col_offset, root.id, attrs[::-1], shape
