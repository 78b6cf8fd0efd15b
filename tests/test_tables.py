import datetime as dt
import json
from unittest import mock

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import usagelens as ul
from tests.conftest import rows
from usagelens.plans.exposure import run_exposure_job
from usagelens.plans.load import run_load_job
from usagelens.plans.main import parse_args
from usagelens.plans.scan import run_scan_job
from usagelens.schemas import REPO_EXPOSURE, USAGE
from usagelens.sinks import jdbc_options, load_table, overwrite, require_columns, send_events
from usagelens.sources import (
    keep_libraries,
    keep_paths,
    read_code,
    read_deprecated,
    read_parts,
    read_topic,
    read_usage,
)
from usagelens.storage import scratch_path, store

MONTH = dt.datetime(2024, 1, 1)
LISTED = [
    {
        "symbol": "gtk.Widget.show_all",
        "library": "gtk",
        "deprecated_in": "3.9",
        "removed_in": "4.0",
        "severity": 3,
        "replacement": "gtk.Widget.show",
    },
    {"symbol": "orm.bulk_save", "library": "orm", "deprecated_in": "2.1", "removed_in": "3.0"},
]


@pytest.fixture
def usage(spark):
    data = [("r1", "gtk.Widget.show_all", MONTH, 5), ("r1", "orm.bulk_save", MONTH, 2), ("r2", "x.y", MONTH, 9)]
    return spark.createDataFrame(data, USAGE)


@pytest.fixture
def listed_path(tmp_path):
    path = tmp_path / "deprecated.json"
    path.write_text(json.dumps(LISTED, indent=2))
    return str(path)


def test_read_code_reads_what_a_walk_finds(spark, tmp_path):
    texts = ["a.py", "_b.py", "p/__init__.py", "p/_q/c.py", ".venv/lib/d.py", "sp ace/e%20.py", "p/é.py"]
    for i, name in enumerate([*texts, "p/none.txt"]):
        (tmp_path / "one" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "one" / name).write_text(f"f{i}()\n")
    (tmp_path / "one" / "folder.py").mkdir()
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.py").write_text("g()\n")
    (tmp_path / "three").mkdir()
    roots = [str(tmp_path / "one"), f"file://{tmp_path}/two/", str(tmp_path / "three"), "/not/there"]
    code = read_code(spark, roots)
    walked = [
        (root.name, str(file.relative_to(root)), file.read_text())
        for root in (tmp_path / "one", tmp_path / "two")
        for file in root.rglob("*.py")
        if file.is_file()
    ]
    assert len(walked) == len(texts) + 1
    assert rows(code.withColumn("content", F.col("content").cast("string"))) == sorted(walked)
    assert read_code(spark, []).count() == 0


def test_call_into_a_package_read_from_a_folder_is_local(spark, tmp_path):
    (tmp_path / "pkg").mkdir()
    (tmp_path / "pkg" / "__init__.py").write_text("def run(): pass\n")
    (tmp_path / "m.py").write_text("import pkg\npkg.run()\n")
    facts = ul.extract_facts(read_code(spark, [str(tmp_path)]))
    assert ul.collect_api_calls(facts, ul.files(facts)).count() == 0
    found = ul.collect_api_calls(facts, ul.files(facts), external_only=False)
    assert rows(found, "file", "is_external", "defining_file") == [("m.py", False, "pkg/__init__.py")]


def test_path_and_library_filters(spark):
    paths = ["a.py", "venv/b.py", "x/.git/c.py", "venv.py", "d.txt", "x/venvs/e.py"]
    files = spark.createDataFrame([("r", p) for p in paths], ["repo", "path"])
    assert keep_paths(files).count() == 6
    kept = keep_paths(files, [".py"], [".git", "venv"])
    assert rows(kept, "path") == [("a.py",), ("venv.py",), ("x/venvs/e.py",)]
    calls = spark.createDataFrame([("os",), ("re",)], ["library"])
    assert keep_libraries(calls).count() == 2
    assert rows(keep_libraries(calls, ["re"])) == [("re",)]


def test_deprecated_list_spans_lines(spark, listed_path):
    found = read_deprecated(spark, listed_path)
    assert rows(found, "symbol", "severity", "replacement") == [
        ("gtk.Widget.show_all", 3, "gtk.Widget.show"),
        ("orm.bulk_save", None, None),
    ]


def test_bad_deprecated_list_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('[{"symbol": "a"')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_deprecated(spark, str(path)).collect()


def test_overwrite_replaces_and_counts(spark, usage, tmp_path):
    path = str(tmp_path / "usage")
    assert overwrite(usage, path) == 3
    assert overwrite(usage.limit(1), path) == 1
    assert read_usage(spark, path).count() == 1


def test_parts_are_merged_by_name(spark, usage, tmp_path):
    path = str(tmp_path / "usage")
    usage.write.parquet(f"{path}/part=1")
    usage.drop("usage_count").write.parquet(f"{path}/part=2")
    merged = require_columns(read_parts(spark, path), USAGE.names)
    assert merged.count() == 6 and merged.filter("usage_count is null").count() == 3


def test_parts_are_found_at_any_depth(spark, usage, tmp_path):
    """Plain sub-folders, ``key=value`` folders at two depths, and a part at the top."""
    path = str(tmp_path / "us age")
    slim = usage.drop("usage_count")
    usage.write.parquet(f"{path}/2024/01")
    usage.write.parquet(f"{path}/2024/02/deep=er%3A/folder")
    usage.write.partitionBy("time_window").parquet(f"{path}/parted")
    slim.write.mode("append").parquet(path)
    found = read_parts(spark, path)
    assert rows(found.filter("usage_count is not null"), *USAGE.names) == sorted(3 * rows(usage), key=repr)
    assert found.count() == 12 and found.filter("deep = 'er:'").count() == 3
    assert read_parts(spark, f"{path}/2024").count() == 6


def test_missing_and_empty_inputs(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_parts(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    assert read_parts(spark, str(tmp_path / "empty")) is None
    assert read_usage(spark, str(tmp_path / "empty")).count() == 0
    assert run_load_job(spark, str(tmp_path / "empty"), {}) == 0


def test_load_refuses_missing_columns_before_writing(spark, usage, tmp_path):
    path = str(tmp_path / "usage")
    usage.drop("repo", "usage_count").write.parquet(path)
    with pytest.raises(ValueError, match="repo, usage_count"):
        run_load_job(spark, path, {})
    with pytest.raises(ValueError, match="if_exists"):
        load_table(usage, "t", {}, USAGE.names, if_exists="merge")


def test_load_writes_contract_columns_over_jdbc(spark, usage, tmp_path):
    """No database here: the write is intercepted, its options and rows are checked."""
    path = str(tmp_path / "usage")
    usage.withColumn("extra", F.lit(1)).write.parquet(path)
    writes, options = [], {}

    def take(writer, *args, **kwargs):
        writes.append((writer._df.columns, len(writer._df.collect())))

    option = DataFrameWriter.option

    def note(writer, key, value):
        options[key] = value
        return option(writer, key, value)

    config = {"database": "d", "user": "u", "password": "p", "host": "db"}
    with mock.patch.object(DataFrameWriter, "save", take), mock.patch.object(DataFrameWriter, "option", note):
        assert run_load_job(spark, path, jdbc_options(config), "api_usage", chunksize=100) == 3
    assert writes == [(USAGE.names, 3)]
    assert options["dbtable"] == "api_usage" and options["batchsize"] == 100


def test_jdbc_options():
    config = {"database": "d", "user": "u", "password": "p"}
    assert jdbc_options(config)["url"] == "jdbc:postgresql://localhost:5432/d"
    assert jdbc_options(config | {"host": "h", "port": 1})["url"] == "jdbc:postgresql://h:1/d"
    with pytest.raises(KeyError):
        jdbc_options({"database": "d", "user": "u"})


def test_scan_sends_events_and_summarises(spark, sources, tmp_path):
    code = sources({"a.py": "import gtk\ngtk.Box(1)\n", "b.py": "import broken("})
    code = code.unionByName(sources({"a.py": "import u\nu.f()\n", "u.py": ""}, repo="s"))
    when = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
    topic = str(tmp_path / "topic")
    scan = run_scan_job(code, str(tmp_path / "work"), scan_time=when, send=True, fmt="parquet", path=topic)
    assert rows(scan.summary) == [("r", 2, 1, 1, 0), ("s", 2, 0, 0, 0)]
    assert rows(scan.diagnostics, "path", "line") == [("b.py", 1)]
    sent = ul.parse_events(spark.read.parquet(topic))
    assert rows(sent, "repo", "file", "symbol_called", "event_time") == [
        ("r", "r/a.py", "gtk.Box", dt.datetime(2024, 1, 5))
    ]
    assert rows(ul.monthly_usage(sent)) == [("r", "gtk.Box", MONTH, 1)]


def test_disabled_topic_sends_nothing(spark, sources, tmp_path):
    events = sources({"a.py": ""})
    send_events(events, enabled=False, fmt="parquet", path=str(tmp_path / "topic"))
    assert not (tmp_path / "topic").exists()


def test_exposure_job(spark, usage, listed_path, tmp_path):
    paths = [str(tmp_path / name) for name in ("usage", "scored", "exposed")]
    overwrite(usage, paths[0])
    for _ in range(2):
        run_exposure_job(spark, paths[0], listed_path, paths[1], paths[2])
    scored = spark.read.parquet(paths[1])
    assert rows(scored, "symbol_called", "severity", "exposure_score") == [
        ("gtk.Widget.show_all", 3, 15),
        ("orm.bulk_save", 1, 2),
    ]
    exposed = spark.read.schema(REPO_EXPOSURE).parquet(paths[2])
    assert rows(exposed) == [("r1", MONTH, 17, 7, 2)]


def test_tracking(spark, sources):
    old = sources({"a.py": "f()", "b.py": "g()"})
    new = sources({"b.py": "g()", "c.py": "h()"})
    delta = ul.file_delta(old, new)
    assert rows(delta, "path", "change") == [("a.py", "removed"), ("c.py", "added")]
    assert rows(ul.calls(ul.extract_added(new, delta)), "base_name") == [("h",)]
    both = ul.add_tracked(old, new.unionByName(new))
    assert rows(both, "path") == [("a.py",), ("b.py",), ("c.py",)]
    assert rows(ul.calls(ul.extract_single(old, "r", "a.py")), "base_name") == [("f",)]
    with pytest.raises(KeyError, match="r/z.py"):
        ul.extract_single(old, "r", "z.py")


def test_store_reads_back_and_prunes(spark, usage):
    stored = store(usage, "test", ["repo"])
    assert rows(stored, *usage.columns) == rows(usage)
    plan = stored.filter("repo = 'r1'").select("usage_count")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(repo" in plan
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_topic_stream(spark):
    """The connector is not installed here; another source takes the same call."""
    stream = read_topic(spark, "host:9092", "calls", fmt="rate", rowsPerSecond="1")
    assert stream.isStreaming and "value" in stream.columns


def test_scan_reads_its_sources_once(spark, sources, tmp_path):
    code = store(sources({"a.py": "import os\nos.getcwd()\nimport re\nre.compile(1)\n"}), "code")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = code.mapInArrow(count, code.schema)
    scan = run_scan_job(counted, str(tmp_path / "work"), target_libraries=["re"])
    assert rows(scan.summary, "tracked_files", "external_calls") == [(1, 1)]
    assert seen.value == 1


def test_months_are_utc_in_any_session(spark):
    from usagelens.functions import month_bucket, month_label

    events = [("r", "p", "p.f", "p.f", t) for t in ("2024-02-01T00:30:00Z", "2024-01-31T23:30:00Z")]
    names = "repo string, library string, symbol string, symbol_called string, t string"

    def months():
        table = spark.createDataFrame(events, names).withColumn("event_time", F.col("t").cast("timestamp"))
        days = ul.daily_usage(table, ("repo", "library", "symbol", "symbol_called"))
        tables = [ul.monthly_usage(table), ul.months_of_days(days)]
        tables.append(table.select(month_bucket(F.col("event_time")).alias("time_window"), F.lit(1)))
        label = month_label(F.col("event_time"))
        return [
            rows(t.withColumn("time_window", F.unix_micros("time_window"))) for t in tables
        ] + [rows(table.select(label))]

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        west = months()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert west == months()
    assert west[-1] == [("2024-01",), ("2024-02",)]


def test_jobs_run_from_the_command_line(spark, tmp_path, monkeypatch):
    from usagelens.plans import main

    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    (tmp_path / "code" / "repo").mkdir(parents=True)
    (tmp_path / "code" / "repo" / "a.py").write_text("import imp as loader\nloader.load_source(1)\n")
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"repos": [str(tmp_path / "code" / "repo")], "exclude_dirs": ["x"]}))
    work = str(tmp_path / "work")
    main.main(["scan", "--settings", str(settings), "--work-path", work, "--apply-filters"])
    usage = ul.monthly_usage(spark.read.parquet(f"{work}/events"), "timestamp")
    paths = {name: str(tmp_path / name) for name in ("usage", "scored", "exposed")}
    overwrite(usage, paths["usage"])
    main.main(
        ["exposure", "--aggregated-path", paths["usage"]]
        + ["--deprecated-usage-output", paths["scored"], "--repo-exposure-output", paths["exposed"]]
    )
    exposed = spark.read.parquet(paths["exposed"])
    assert rows(exposed, "repo", "exposure_score") == [("repo", 5)]


def test_command_line():
    args = parse_args(["load", "repo_exposure", "--config", "c", "--parquet-path", "p"])
    assert (args.what, args.if_exists, args.chunksize) == ("repo_exposure", "append", 5000)
    assert parse_args(["exposure"]).aggregated_path == "results/aggregated_usage"
    with pytest.raises(SystemExit):
        parse_args(["usage"])


def parts(tmp_path, **tables):
    for name, table in tables.items():
        pq.write_table(pa.table(table), tmp_path / f"{name}.parquet")
    return str(tmp_path)


WIDENED = [
    (pa.int16(), pa.int32(), "int"),
    (pa.int32(), pa.int64(), "bigint"),
    (pa.int64(), pa.float64(), "double"),
    (pa.float32(), pa.float64(), "double"),
    (pa.int8(), pa.float32(), "double"),
    (pa.decimal128(9, 2), pa.decimal128(12, 4), "decimal(12,4)"),
    (pa.timestamp("us"), pa.timestamp("us", "UTC"), "timestamp"),
]


@pytest.mark.parametrize("one, other, wide", WIDENED)
def test_parts_of_two_types_have_the_wider(spark, tmp_path, one, other, wide):
    import decimal

    values = [decimal.Decimal(1), decimal.Decimal(2)] if "decimal" in wide else [1, 2]
    tables = {f"a{i}": {"n": pa.array(values, one), "k": [i] * 2} for i in range(3)}
    tables |= {f"b{i}": {"n": pa.array(values, other)} for i in range(3)}
    found = read_parts(spark, parts(tmp_path, **tables))
    assert found.schema["n"].dataType.simpleString() == wide
    assert found.count() == 12 and found.filter("n IS NULL").count() == 0
    assert found.filter("k IS NOT NULL").count() == 6


def test_parts_with_nulls_only_take_any_type(spark, tmp_path):
    path = parts(
        tmp_path,
        a={"n": pa.array([None, None], pa.null())},
        b={"n": pa.array(["x", None])},
        c={"n": pa.array([None], pa.float64())},
    )
    assert rows(read_parts(spark, path)) == sorted([("x",), *[(None,)] * 4], key=repr)


def test_text_and_numbers_clash(spark, tmp_path):
    path = parts(tmp_path, a={"n": [1], "m": [1]}, b={"n": ["x"], "m": [2]})
    with pytest.raises(ValueError, match="column n is bigint and string"):
        read_parts(spark, path)


def test_types_differ_between_keyed_folders(spark, tmp_path):
    for name, kind in (("1", pa.int32()), ("2", pa.int64()), ("x", pa.int64())):
        (tmp_path / f"part={name}").mkdir()
        parts(tmp_path / f"part={name}", f={"n": pa.array([5], kind)})
    found = read_parts(spark, str(tmp_path))
    assert rows(found, "part", "n") == [("1", 5), ("2", 5), ("x", 5)]


def test_only_conflicting_files_are_looked_at_apart(spark, tmp_path, monkeypatch):
    """Of 64 files from three writes the schemas are found with few reads."""
    from usagelens.sources import tables

    kinds = ["int"] * 40 + ["bigint"] * 23 + ["double"]
    for i, kind in enumerate(kinds):
        name = f"part-{i:05}-write{['int', 'bigint', 'double'].index(kind)}-c000.parquet"
        array = pa.array([i], {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[kind])
        pq.write_table(pa.table({"n": array}), tmp_path / name)
    reads = []
    alike = tables._alike

    class Counting:
        def __init__(self, reader):
            self.reader = reader

        def parquet(self, *files):
            reads.append(len(files))
            return self.reader.parquet(*files)

    monkeypatch.setattr(tables, "_alike", lambda reader, files: alike(Counting(reader), files))
    found = read_parts(spark, str(tmp_path))
    assert found.schema["n"].dataType.simpleString() == "double" and found.count() == 64
    assert len(reads) < 40
