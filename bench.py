"""Times the headline queries over whole tables and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. One small parse
first starts the JVM and the Python workers; each query is then run once, to a sink that reads
every row and column. Code is parsed and its facts stored once, as ``parse_and_store``; queries
that resolve names start from there.
"""

import importlib.util
import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "usage_daily",
    "usage_monthly",
    "repo_exposure",
    "event_json_roundtrip",
    "usage_stream_closed",
    "code_calls",
    "symbol_declarations",
    "import_edges",
    "dependents",
    "qualified_names",
    "api_calls_external",
    "api_calls_full_mode",
    "scan_summary",
    "code_to_exposure",
]


def load_entry():
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = load_entry()
    files = [("r", f"f{i}.py", "f()") for i in range(8)]
    sources = spark.createDataFrame(files, ["repo", "path", "content"])
    entry.ul.extract_facts(sources.repartition(8)).count()

    seconds = {}
    start = time.perf_counter()
    stored = entry._stored_facts(spark, sf_dir)
    seconds["parse_and_store"] = round(time.perf_counter() - start, 3)
    entry._stored_facts = lambda *_: stored
    for name in HEADLINE:
        start = time.perf_counter()
        result = entry.queries()[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
