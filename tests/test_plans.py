"""Properties of the physical plans that keep the operators cheap at scale."""

import re

import pytest
from pyspark.sql import functions as F

import usagelens as ul
from tests.test_queries import SF_DIR
from usagelens.plans import event_corpus as corpus
from usagelens.storage import store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|Round|range|Single)", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The code files as a source table and its facts, both stored."""
    folder = tmp_path_factory.mktemp("stored")
    sources = corpus.code_sources(corpus.read_events(spark, str(SF_DIR)))
    sources = store(sources, "sources", path=f"{folder}/sources")
    return sources, store(ul.extract_facts(sources), "facts", ["kind"], f"{folder}/facts")


def test_extraction_shuffles_nothing(stored):
    sources, _ = stored
    assert exchanges(plan(ul.extract_facts(sources))) == 0


def test_module_index_never_reads_source_text(stored):
    sources, _ = stored
    text = plan(ul.module_index(sources))
    assert "content" not in text and "ReadSchema: struct<repo:string,path:string>" in text
    assert exchanges(text) == 1


def test_calls_are_shuffled_once(stored):
    """All of a file's names, edges and calls meet in one exchange; both lookups reuse it."""
    sources, facts = stored
    text = plan(ul.collect_api_calls(facts, sources.select("repo", "path")))
    above, below = text.split("REPARTITION_BY_COL", 1)
    assert "REPARTITION_BY_COL" not in below
    assert above.count("Window") == 2 and exchanges(above) == 1
    assert "SortMergeJoin" not in above


def test_lookups_read_each_side_once(stored):
    """No ranking of keys and nothing stored on the way: imports, files and calls are read once."""
    sources, facts = stored
    files = sources.select("repo", "path")
    edges = plan(ul.import_edges(facts, files))
    assert edges.count("FileScan") == 2 and "TakeOrdered" not in edges
    for mode, scans in (("reference", 4), ("full", 5)):
        text = plan(ul.collect_api_calls(facts, files, mode=mode))
        assert text.count("FileScan") <= scans and "TakeOrdered" not in text


def test_qualified_lookup_writes_nothing(spark, stored):
    sources, facts = stored
    names = ul.calls(facts).select("repo", "path", "base_name", F.get("attr_chain", F.lit(0)).alias("attr_name"))
    spark.sparkContext.setJobGroup("qualified", "")
    ul.resolve_qualified(names, facts, sources.select("repo", "path"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("qualified")


def test_fact_scans_are_pruned(stored):
    _, facts = stored
    text = plan(ul.calls(facts).select("base_name"))
    assert "PartitionFilters: [isnotnull(kind" in text
    assert "ReadSchema: struct<base_name:string>" in text
    bound = plan(ul.bindings(facts).select("name", "target"))
    assert re.search(r"PartitionFilters: \[.*import.*definition", bound)
    assert "signature_shape" not in bound


def test_symbol_targets_skip_the_declaration_lists(stored):
    _, facts = stored
    text = plan(ul.symbols(facts).select("repo", "path", "name", "target"))
    assert "collect_list" not in text and exchanges(text) == 1


def test_usage_scans_are_pruned_and_pre_aggregated(spark):
    events = corpus.usage_events(corpus.read_events(spark, str(SF_DIR)))
    for counted in (ul.daily_usage(events), ul.monthly_usage(events)):
        text = plan(counted)
        assert "IsNotNull(ts)" in text and "event_id" not in text
        assert "partial_count(1)" in text and exchanges(text) == 1
        assert "Python" not in text


def test_small_list_is_broadcast_and_large_one_is_not(spark, tmp_path):
    from usagelens.schemas import DEPRECATED_APIS, USAGE

    usage = spark.read.schema(USAGE).parquet(str(tmp_path))
    spark.createDataFrame([], DEPRECATED_APIS).write.mode("append").json(f"{tmp_path}/list")
    listed = spark.read.schema(DEPRECATED_APIS).json(f"{tmp_path}/list")
    assert "BroadcastHashJoin" in plan(ul.deprecated_usage(usage, listed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in plan(ul.deprecated_usage(usage, listed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_messages_are_read_once(spark):
    """A filter on the time does not read the JSON again."""
    messages = spark.createDataFrame([('{"repo": "r", "event_time": "2024-01-01T00:00:00Z"}',), ("no",)], "value string")
    for found in (ul.monthly_usage(ul.parse_events(messages)), ul.parse_events(messages).filter("event_time > '2020-01-01'")):
        assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [r.asDict()["repo"] for r in ul.parse_events(messages).collect()] == ["r", None]


def test_tasks_that_make_files_grow_with_the_events(spark, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "FILES_PER_TASK", 10)
    folder = "/root/testdata/sf0.001"
    n = entry.corpus.read_events(spark, folder).count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // 10))
    assert entry._wide_events(spark, folder).rdd.getNumPartitions() == tasks


def test_stream_rows_are_spread_before_messages_are_made(spark):
    import __spark_entry__ as entry

    messages = entry._message_stream(spark, "/root/testdata/sf0.001")
    text = messages._jdf.queryExecution().analyzed().toString()
    assert text.index("to_json") < text.index("Repartition")


def test_module_index_is_hashed(stored):
    sources, _ = stored
    assert "SortAggregate" not in plan(ul.module_index(sources))
