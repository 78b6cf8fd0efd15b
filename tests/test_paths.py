import pytest
from pyspark.sql import functions as F

from usagelens import functions as fn

BASES = [
    ("pkg/sub/m.py", "u", 1, "pkg.sub.u"),
    ("pkg/sub/m.py", "u", 2, "pkg.u"),
    ("pkg/sub/m.py", None, 1, "pkg.sub"),
    ("pkg/sub/m.py", "u", 3, "u"),
    ("pkg/sub/m.py", "u", 4, None),
    ("m.py", None, 1, None),
    ("pkg/__init__.py", "u", 1, "pkg.u"),
    ("m.py", "os.path", 0, "os.path"),
    ("m.py", None, 0, None),
    ("pkg/m.txt", "u", 1, None),
    ("a.b/m.py", "u", 2, "a.u"),
    ("pkg/.py", "u", 1, None),
    ("pkg/sub/m.py", "a.b", 2, "pkg.a.b"),
]


def test_relative_base(spark):
    df = spark.createDataFrame(BASES, "path string, module string, level int, expected string")
    base = fn.relative_base(F.col("path"), F.col("module"), F.col("level"))
    wrong = df.withColumn("base", base).filter(~F.col("base").eqNullSafe(F.col("expected")))
    assert wrong.collect() == []


@pytest.mark.parametrize(
    "path, module",
    [("a/b.py", "a.b"), ("a.py", "a"), ("a/__init__.py", "a.__init__"), ("a.txt", None), (".py", None)],
)
def test_module_name(spark, path, module):
    df = spark.createDataFrame([(path,)], ["path"])
    assert df.select(fn.module_name(F.col("path"))).first()[0] == module


def test_symbol_parts(spark):
    df = spark.createDataFrame([("a.b.c",), ("a",)], ["t"])
    t = F.col("t")
    found = df.select(fn.module_prefix(t), fn.library_of(t), fn.full_symbol(t, F.lit("n"), F.array(F.lit("x"))))
    assert [tuple(r) for r in found.collect()] == [("a.b", "a", "a.b.c.x"), ("a", "a", "a.x")]
    alone = df.limit(1).select(fn.full_symbol(F.lit(None), F.lit("n"), F.array().cast("array<string>")))
    assert alone.first()[0] == "n"
