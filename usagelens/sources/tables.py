"""Stored tables the batch steps start from."""

from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.schemas import DEPRECATED_APIS, USAGE


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Monthly usage. The schema is given, so a folder still empty reads as no rows."""
    return spark.read.schema(USAGE).parquet(path)


def read_deprecated(spark: SparkSession, path: str) -> DataFrame:
    """The deprecated list, a JSON array of objects that may span lines; bad JSON is an error."""
    reader = spark.read.schema(DEPRECATED_APIS).option("multiLine", True)
    return reader.option("mode", "FAILFAST").json(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """All ``*.parquet`` parts at any depth under ``path`` by column name.

    A column missing in some parts is null there, also where ``key=value`` folders give it to
    others. A column whose type differs has the widest: of whole numbers the longest, a double with
    any float, a decimal of the digits of all, a timestamp with a zone (of the session) if some have
    one. Types that none holds both of are an error naming the column, unless all parts of one type
    hold nulls only. A missing path is an error. A path without any part gives None.

    Schemas are merged by Spark's own parallel job; only if they conflict is the list of files
    halved until those that agree are apart, one branch of the result for each schema there is.
    """
    reader = spark.read.option("mergeSchema", True)
    try:
        every = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        files = [unquote(file) for file in every.schema(T.StructType([])).parquet(path).inputFiles()]
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    if not files:
        return None
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        layouts.setdefault(_layout(file, path), []).append(file)
    tables, folders = [], set()
    for (base, *keys), parts in layouts.items():
        reader = spark.read.option("mergeSchema", True)
        folders.update(keys)
        tables += _alike(reader.option("basePath", base) if keys else reader, sorted(parts, key=_run))
    return _unite(tables, folders)


def _run(file: str) -> tuple[str, str]:
    """Sorts a folder's parts by the write that made them, which Spark puts after their number."""
    folder, _, name = file.rpartition("/")
    return folder, name.partition("-")[2].partition("-")[2] or name


def _alike(reader: DataFrameReader, files: list[str]) -> list[DataFrame]:
    """The files as tables, each of those whose schemas merge."""
    by_schema: dict[str, list[str]] = {}
    unseen = [files]
    while unseen:
        some = unseen.pop()
        try:
            schema = reader.parquet(*some).schema
        except Exception as error:  # not a Python class of its own in every version
            if "CANNOT_MERGE_SCHEMAS" not in str(error) or len(some) == 1:
                raise
            half = len(some) // 2
            unseen += [some[half:], some[:half]]
            continue
        by_schema.setdefault(schema.json(), []).extend(some)
    return [reader.parquet(*some) for some in by_schema.values()]


def _unite(tables: list[DataFrame], folders: set[str]) -> DataFrame:
    """The tables by column name, columns of different types cast to the widest."""
    types: dict[str, list[tuple[T.DataType, int]]] = {}
    for i, table in enumerate(tables):
        for field in table.schema:
            types.setdefault(field.name, []).append((field.dataType, i))
    for name, held in types.items():
        wide = reduce(_wider_or_none, [kind for kind, _ in held])
        if wide is None and name in folders:
            wide = T.StringType()
        if wide is None:
            used = [(kind, i) for kind, i in held if not _all_null(tables[i], name)]
            wide = reduce(_wider_or_none, [kind for kind, _ in used]) if used else held[0][0]
            for i in {i for _, i in held} - {i for _, i in used}:
                tables[i] = tables[i].withColumn(name, F.lit(None).cast(wide or T.NullType()))
        if wide is None:
            kinds = " and ".join(sorted({kind.simpleString() for kind, _ in held}))
            raise ValueError(f"column {name} is {kinds} in different parts, and nothing holds both")
        for kind, i in held:
            if kind != wide:
                tables[i] = tables[i].withColumn(name, F.col(f"`{name}`").cast(wide))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _all_null(table: DataFrame, name: str) -> bool:
    return table.filter(F.col(f"`{name}`").isNotNull()).isEmpty()


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_BROKEN = [T.FloatType(), T.DoubleType()]
_TIMES = [T.TimestampNTZType(), T.TimestampType()]


def _wider_or_none(a: T.DataType | None, b: T.DataType | None) -> T.DataType | None:
    """The least type that holds the values of both, if there is one."""
    if a == b or a is None or b is None:
        return a if a == b else None
    for order in (_WHOLE, _BROKEN, _TIMES):
        if a in order and b in order:
            return max(a, b, key=order.index)
    if {a, b} <= {*_WHOLE, *_BROKEN}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def _layout(file: str, root: str) -> tuple[str, ...]:
    """The folder that holds a part's ``key=value`` folders, if any, and their keys."""
    below = urlsplit(file).path.split("/")[1:-1]
    above = len([name for name in urlsplit(root).path.split("/") if name])
    keyed = [i for i in range(above, len(below)) if "=" in below[i]]
    if not keyed:
        return ("",)
    rest = "/".join(below[keyed[0] :])
    base = file.rpartition("/")[0].removesuffix(rest).rstrip("/")
    return base, *[below[i].partition("=")[0] for i in keyed]
