"""Source code as a table, and the optional filters on it."""

import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ship the worker code inside the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH_BYTES = 8 << 20


def read_code(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Every ``*.py`` file under the given repo roots: repo, path, content (bytes).

    The repo label is the last part of its root; roots with the same last part merge, and a file
    below two roots belongs to both. Names are not filtered, so ``__init__.py`` and folders like
    ``.venv`` are read; ``keep_paths`` drops what is not wanted. A root that is missing or holds no
    Python file adds no rows. Roots are absolute paths or URIs.

    Folders are listed in tasks, first the roots and then each of their sub-folders, as Spark's
    own listing hides names that start with ``_`` or ``.``. Contents are read after the paths are
    spread over all tasks. Very many small files are slow to open wherever they lie, so at scale
    keep sources in a table of the same shape.
    """
    found = spark.createDataFrame(
        [(root, "", True) for root in sorted({_plain(root) for root in roots})],
        "root string, path string, is_folder boolean",
    )
    found = found.repartition("root").mapInArrow(_list_folders, found.schema)
    below = found.repartition("root", "path").mapInArrow(_list_trees, found.schema)
    return below.repartition("root", "path").mapInArrow(
        _read_files, "repo string, path string, content binary"
    )


def _entries(root: str, path: str, recursive: bool) -> Iterator[tuple[str, bool]]:
    """Paths below ``root`` of the Python files and folders in one of its folders."""
    system, base = pafs.FileSystem.from_uri(root)
    base = base.rstrip("/")
    where = f"{base}/{path}" if path else base or "/"
    selector = pafs.FileSelector(where, allow_not_found=True, recursive=recursive)
    for entry in system.get_file_info(selector):
        is_folder = entry.type == pafs.FileType.Directory
        if is_folder or entry.path.endswith(".py"):
            yield entry.path[len(base) + 1 :], is_folder


def _list_folders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = _entries(row["root"], row["path"], recursive=False)
            yield _listed([(row["root"], *entry) for entry in found])


def _list_trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            if row["is_folder"]:
                found = _entries(row["root"], row["path"], recursive=True)
                yield _listed([(row["root"], path, False) for path, folder in found if not folder])
            else:
                yield _listed([tuple(row.values())])


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = [pa.string(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["root", "path", "is_folder"]
    )


def _read_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            system, base = pafs.FileSystem.from_uri(row["root"])
            with system.open_input_stream(f"{base.rstrip('/')}/{row['path']}") as stream:
                content = stream.read()
            rows.append((base.rstrip("/").rpartition("/")[2], row["path"], content))
            size += len(content)
            if size >= _BATCH_BYTES:
                yield _contents(rows)
                rows, size = [], 0
    if rows:
        yield _contents(rows)


def _contents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["repo", "path", "content"]
    )


def _plain(root: str) -> str:
    root = root.rstrip("/")
    return "/" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root


def keep_paths(
    sources: DataFrame,
    include_extensions: Sequence[str] | None = None,
    exclude_dirs: Sequence[str] = (),
) -> DataFrame:
    """Drop files with other extensions or below an excluded folder. Nothing is dropped by default."""
    if include_extensions is not None:
        wanted = F.lit(False)
        for extension in include_extensions:
            wanted = wanted | F.col("path").endswith(extension)
        sources = sources.filter(wanted)
    if exclude_dirs:
        parts = F.split("path", "/")
        folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
        excluded = F.array(*[F.lit(name) for name in exclude_dirs])
        sources = sources.filter(~F.arrays_overlap(folders, excluded))
    return sources


def keep_libraries(calls: DataFrame, target_libraries: Sequence[str] = ()) -> DataFrame:
    """Only calls into the named libraries; all of them when none is named."""
    return calls.filter(F.col("library").isin(*target_libraries)) if target_libraries else calls
