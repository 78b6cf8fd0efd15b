"""Command line for the jobs, one subcommand each."""

import argparse
import json
import os
from collections.abc import Sequence

from usagelens.plans.exposure import run_exposure_job
from usagelens.plans.load import LOADS, run_load_job
from usagelens.plans.scan import run_scan_job
from usagelens.plans.usage import run_usage_job
from usagelens.session import build_session
from usagelens.sinks.database import WRITE_MODES, jdbc_options
from usagelens.sources import keep_paths, read_code, read_topic
from usagelens.streaming.usage import FILES_PER_FOLDER

# Where each job looks unless told otherwise.
TOPIC = "ast.api_calls"
SERVERS = "localhost:9092"
CLIENT = "api-usage-scanner"
AGGREGATED_PATH = "results/aggregated_usage"
DEPRECATED_APIS_PATH = "configs/deprecated_apis.json"
DEPRECATED_USAGE_PATH = "results/deprecated_usage"
REPO_EXPOSURE_PATH = "results/exposure_scores"

# Source files can be megabytes each, so a scan decodes few rows of a source table at a time.
SESSION = {"scan": {"spark.sql.parquet.columnarReaderBatchSize": "512"}}


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="usagelens", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    scan = jobs.add_parser("scan", help="scan code for external calls")
    scan.add_argument("--settings", required=True, help="JSON file: repos and kafka settings")
    scan.add_argument("--work-path", required=True, help="shared folder for facts and events")
    scan.add_argument("--mode", choices=["reference", "full"], default="reference")
    scan.add_argument("--apply-filters", action="store_true", help="apply the path and library settings")

    usage = jobs.add_parser("usage", help="count calls per day and month")
    usage.add_argument("--kafka-bootstrap-servers", required=True)
    usage.add_argument("--kafka-topic", required=True)
    usage.add_argument("--output-path", required=True)
    usage.add_argument("--checkpoint-path", required=True)
    usage.add_argument("--usage-path", help="also keep the monthly table here")
    usage.add_argument("--state-partitions", type=int)
    usage.add_argument("--files-per-folder", type=int, default=FILES_PER_FOLDER)
    usage.add_argument("--by-library", action="store_true", help="folders by library, not month")
    usage.add_argument("--once", action="store_true", help="count repeated messages once")

    exposure = jobs.add_parser("exposure", help="score usage of deprecated symbols")
    exposure.add_argument("--aggregated-path", default=AGGREGATED_PATH)
    exposure.add_argument("--deprecated-apis-path", default=DEPRECATED_APIS_PATH)
    exposure.add_argument("--deprecated-usage-output", default=DEPRECATED_USAGE_PATH)
    exposure.add_argument("--repo-exposure-output", default=REPO_EXPOSURE_PATH)

    load = jobs.add_parser("load", help="load a Parquet table into a database")
    load.add_argument("what", choices=list(LOADS))
    load.add_argument("--config", required=True, help="JSON file with a 'postgres' object")
    load.add_argument("--parquet-path", required=True)
    load.add_argument("--table")
    load.add_argument("--if-exists", choices=list(WRITE_MODES), default="append")
    load.add_argument("--chunksize", type=int, default=5000)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session(f"usagelens-{args.job}", **SESSION.get(args.job, {}))
    if args.job == "scan":
        settings = _read_json(args.settings)
        kafka = settings.get("kafka", {})
        roots = [r if "://" in r else os.path.abspath(r) for r in settings.get("repos", [])]
        sources = read_code(spark, roots)
        if args.apply_filters:
            sources = keep_paths(
                sources, settings.get("include_extensions"), settings.get("exclude_dirs", ())
            )
        topic = {
            "topic": kafka.get("topic", TOPIC),
            "kafka.bootstrap.servers": kafka.get("bootstrap_servers", SERVERS),
            "kafka.client.id": kafka.get("client_id", CLIENT),
        }
        enabled = kafka.get("enabled", False)
        libraries = settings.get("target_libraries", ()) if args.apply_filters else ()
        scan = run_scan_job(
            sources, args.work_path, args.mode, send=enabled, target_libraries=libraries, **topic
        )
        scan.summary.show()
    elif args.job == "usage":
        messages = read_topic(spark, args.kafka_bootstrap_servers, args.kafka_topic)
        counts = run_usage_job(
            messages,
            args.output_path,
            args.checkpoint_path,
            args.usage_path,
            state_partitions=args.state_partitions,
            files_per_folder=args.files_per_folder,
            by_library=args.by_library,
            once=args.once,
        )
        print(", ".join(f"{name} {rows} rows" for name, rows in counts._asdict().items()))
    elif args.job == "exposure":
        run_exposure_job(
            spark,
            args.aggregated_path,
            args.deprecated_apis_path,
            args.deprecated_usage_output,
            args.repo_exposure_output,
        )
    else:
        rows = run_load_job(
            spark,
            args.parquet_path,
            jdbc_options(_read_json(args.config)["postgres"]),
            args.what,
            args.table,
            args.if_exists,
            args.chunksize,
        )
        print(f"loaded {rows} rows")
    spark.stop()


def _read_json(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


if __name__ == "__main__":
    main()
