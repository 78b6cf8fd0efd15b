import ast
import os
import subprocess
import sys
import sysconfig
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import usagelens as ul
from tests.conftest import rows

SHAPE = ("signature_shape.positional_count", "signature_shape.keyword_args")
STARS = ("signature_shape.has_varargs", "signature_shape.has_varkw")


def facts_of(sources, content, path="a.py"):
    return ul.extract_facts(sources({path: content}))


def test_module_alias_call(sources):
    code = "import shapely as geo\nclass Map:\n    area = geo.box(0, 0, 1, 2)\n"
    found = ul.calls(facts_of(sources, code))
    assert rows(found, "line", "col", "base_name", "attr_chain", *SHAPE) == [
        (3, 11, "geo", ["box"], 4, [])
    ]


def test_from_alias_call(sources):
    code = "from zlib import crc32 as check\nsums = [check(part, value=7) for part in ()]\n"
    found = ul.calls(facts_of(sources, code))
    assert rows(found, "base_name", "attr_chain", *SHAPE) == [("check", [], 1, ["value"])]


def test_signature_shape(sources):
    code = 'pd.read_csv(path, sep=",", header=0, **opts)\nf(*a, 1, *b)\n'
    found = ul.calls(facts_of(sources, code))
    assert rows(found, "base_name", *SHAPE, *STARS) == [
        ("f", 1, [], True, False),
        ("pd", 1, ["header", "sep"], False, True),
    ]


def test_only_names_and_attribute_chains_are_callees(sources):
    code = 'print(1)\n(lambda: 1)()\nd["k"]()\nf()()\na.b.c()\na().b()\n'
    found = ul.calls(facts_of(sources, code))
    assert rows(found, "line", "base_name", "attr_chain") == [
        (1, "print", []),
        (4, "f", []),
        (5, "a", ["b", "c"]),
        (6, "a", []),
    ]


def test_imports(sources):
    code = (
        "import a.b, c as d\n"
        "def g():\n"
        "    from ..m import n as k, o\n"
        "from . import x\n"
        "from s import *\n"
    )
    found = ul.imports(facts_of(sources, code))
    columns = ("seq", "is_from", "module", "level", "name", "local_name", "statement_names")
    assert rows(found, *columns) == [
        (0, False, "a.b", 0, None, "a", None),
        (1, False, "c", 0, None, "d", None),
        (2, True, "m", 2, "n", "k", ["n", "o"]),
        (3, True, "m", 2, "o", "o", None),
        (4, True, None, 1, "x", "x", ["x"]),
        (5, True, "s", 0, "*", "*", ["*"]),
    ]


def test_definitions_are_module_level(sources):
    code = (
        "a, b = 1, 2\nX: int\nY = Z = 3\nobj.attr = 4\n"
        "class C:\n    def method(self): pass\n"
        "async def f(): pass\n"
        "if True:\n    def nested(): pass\n"
    )
    found = ul.definitions(facts_of(sources, code))
    assert rows(found, "seq", "kind", "name") == [
        (0, "variable", "X"),
        (1, "variable", "Y"),
        (2, "variable", "Z"),
        (3, "class", "C"),
        (4, "function", "f"),
    ]


def test_broken_file_gives_one_diagnostic(sources):
    facts = facts_of(sources, "import os\nimport broken(", "pkg/bad.py")
    assert rows(ul.diagnostics(facts)) == [("r", "pkg/bad.py", "invalid syntax (bad.py, line 2)", 2, 14)]
    assert facts.filter("kind <> 'file'").count() == 1


@pytest.mark.parametrize("content", [b"\xff\xfe", "x = 1\x00", "-" * 200_000 + "1", "(" * 5000])
def test_unparsable_content_never_fails_the_task(spark, content):
    kind = T.BinaryType() if isinstance(content, bytes) else T.StringType()
    schema = T.StructType(
        [
            T.StructField("repo", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("content", kind),
        ]
    )
    df = spark.createDataFrame([("r", "a.py", content)], schema)
    assert rows(ul.extract_facts(df), "kind") == [("diagnostic",), ("file",)]


def test_bytes_and_text_agree(spark, sources):
    text = "import naïve as é\né.run('ü')\n"
    as_text = sources({"a.py": text})
    as_bytes = as_text.withColumn("content", F.encode("content", "UTF-8"))
    assert rows(ul.extract_facts(as_text)) == rows(ul.extract_facts(as_bytes))


def test_files_too_complex_are_counted_apart(sources):
    deep = sources({"a.py": "-" * 200_000 + "1", "b.py": "import broken(", "c.py": "f()"})
    facts = ul.extract_facts(deep)
    found = ul.scan_summary(facts, ul.files(facts), ul.collect_api_calls(facts, ul.files(facts)))
    assert rows(found, "tracked_files", "diagnostics", "too_complex") == [(3, 2, 1)]


def test_a_worker_short_of_memory_fails_its_task(monkeypatch):
    from usagelens.operators import extract

    def short(*_, **__):
        raise MemoryError

    monkeypatch.setattr(extract.ast, "parse", short)
    with pytest.raises(MemoryError):
        list(extract._facts_of_file("a.py", "f()"))


def test_empty_and_null_content_have_no_facts(sources):
    assert rows(ul.extract_facts(sources({"a.py": "", "b.py": None})), "kind") == [("file",)] * 2


def test_matches_a_plain_walk_over_the_standard_library(spark):
    """Every call and import a full tree walk sees is found, on real files."""
    folder = Path(sysconfig.get_paths()["stdlib"])
    files = {str(p): p.read_bytes() for p in sorted(folder.glob("*.py"))}
    calls, imports = set(), set()
    for path, content in files.items():
        for node in ast.walk(ast.parse(content)):
            if isinstance(node, ast.Call):
                root = node.func
                while isinstance(root, ast.Attribute):
                    root = root.value
                if isinstance(root, ast.Name):
                    calls.add((path, node.lineno, node.col_offset, root.id))
            elif isinstance(node, (ast.Import, ast.ImportFrom)):
                for pos, _ in enumerate(node.names):
                    imports.add((path, node.lineno, node.col_offset, pos))
    df = spark.createDataFrame([("std", p, bytearray(c)) for p, c in files.items()], ["repo", "path", "content"])
    facts = ul.extract_facts(df.repartition(8)).persist()
    assert {tuple(r) for r in ul.calls(facts).select("path", "line", "col", "base_name").collect()} == calls
    found = ul.imports(facts).select("path", "line", "col", "alias_pos")
    assert {tuple(r) for r in found.collect()} == imports
    facts.unpersist()


def test_workers_need_no_installed_package(tmp_path):
    """Extraction runs though the package is only on the driver's path."""
    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
import usagelens as ul
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("r", "a.py", "f()")], ["repo", "path", "content"])
print("calls:", ul.calls(ul.extract_facts(df)).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "calls: 1" in done.stdout, done.stderr[-2000:]


def test_widen_runs_no_job(spark):
    grouped = spark.range(100).groupBy("id").count()
    spark.sparkContext.setJobGroup("widen", "")
    wide = ul.widen(grouped, 6)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("widen")
    assert "RoundRobinPartitioning(6)" in wide._jdf.queryExecution().executedPlan().toString()


def loads(spark, table, tasks):
    """Bytes and files of each task after balancing."""
    from pyspark.sql import functions as F

    wide = ul.balance(table, tasks).withColumn("task", F.spark_partition_id())
    assert rows(wide.drop("task")) == rows(table)
    found = wide.groupBy("task").agg(F.sum(F.octet_length("content")), F.max(F.octet_length("content")))
    return [(size, largest) for _, size, largest in found.collect()]


def test_balanced_tasks_have_about_the_same_bytes(spark, sources):
    import random

    pick = random.Random(1)
    skewed = {f"s{i}.py": "x" * pick.randint(50, 150) for i in range(1980)}
    skewed |= {f"l{i}.py": "y" * pick.randint(50_000, 120_000) for i in range(20)}
    for tasks in (3, 8, 16):
        found = loads(spark, sources(skewed), tasks)
        mean = sum(size for size, _ in found) / tasks
        assert len(found) == tasks
        assert all(size <= 2 * mean or size - largest < 0.1 * mean for size, largest in found)
    small = loads(spark, sources({f"s{i}.py": "x" * pick.randint(50, 150) for i in range(2000)}), 8)
    assert max(small)[0] < 1.3 * sum(size for size, _ in small) / 8
    one = loads(spark, sources({"big.py": "x" * 500_000, **{f"s{i}.py": "x" * 100 for i in range(500)}}), 4)
    assert max(one)[0] < 510_000 and len(one) == 4


def test_balancing_few_or_empty_files(spark, sources):
    assert loads(spark, sources({"a.py": None, "b.py": ""}), 4)
    assert loads(spark, sources({"a.py": "f()"}).selectExpr("repo", "path", "cast(content as binary) as content"), 4)
    assert loads(spark, sources({"a.py": "f()"}).limit(0), 4) == []


def test_every_file_read_is_a_fact(sources):
    facts = ul.extract_facts(sources({"a.py": "f()", "b.py": "import broken(", "c.py": None}))
    assert rows(ul.files(facts)) == [("r", "a.py"), ("r", "b.py"), ("r", "c.py")]


def test_equal_texts_are_parsed_once_and_keep_their_own_paths(monkeypatch):
    import pyarrow as pa

    from usagelens.operators import extract

    parsed = []

    def parse(text, **options):
        parsed.append(text)
        return ast_parse(text, **options)

    ast_parse = ast.parse
    monkeypatch.setattr(extract.ast, "parse", parse)
    monkeypatch.setattr(extract, "_ROWS_PER_BATCH", 4)
    texts = ["import a, b\na.f()\n", "import broken(", None, "b'\x00'", "def f(): pass\n"] * 3
    files = [(f"r{i % 2}", f"d/f{i}.py", text) for i, text in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*files)], ["repo", "path", "content"])
    given = list(extract._facts_of_batches([batch]))
    assert sorted(parsed) == sorted({text or "" for text in texts})
    assert max(b.num_rows for b in given) <= 4
    one_by_one = [
        row for i in range(len(files)) for b in extract._facts_of_batches([batch.slice(i, 1)]) for row in b.to_pylist()
    ]
    assert sorted(map(repr, one_by_one)) == sorted(repr(row) for b in given for row in b.to_pylist())
    said = {row["path"]: row["message"] for b in given for row in b.to_pylist() if row["kind"] == "diagnostic"}
    assert {p: m for p, m in said.items() if "broken" not in m and "syntax" in m} == {
        f"d/f{i}.py": f"invalid syntax (f{i}.py, line 1)" for i in (1, 6, 11)
    }
