import datetime as dt

from pyspark.sql import functions as F

import usagelens as ul
from tests.conftest import rows
from usagelens.operators.usage import REPO_KEYS


def at(text):
    return dt.datetime.fromisoformat(text)


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


def test_both_spellings_and_broken_messages(spark):
    parsed = ul.parse_events(
        messages(
            spark,
            [
                '{"repo":"r","file":"r/a.py","symbol_called":"p.f","library":"p",'
                '"timestamp":"2024-01-02T03:04:05.678901+00:00"}',
                '{"repo_name":"r","file_path":"a.py","symbol":"f","library":"p",'
                '"call_full_name":"p.f","event_time":"2024-01-02T03:04:05Z"}',
                "not json",
                None,
            ],
        )
    )
    columns = ("repo", "file", "library", "symbol", "symbol_called", "event_time")
    assert rows(parsed, *columns) == [
        ("r", "a.py", "p", "f", "p.f", at("2024-01-02T03:04:05")),
        ("r", "r/a.py", "p", "p.f", "p.f", at("2024-01-02T03:04:05.678901")),
        (None,) * 6,
        (None,) * 6,
    ]


def events(spark):
    data = [
        ("r1", "p", "p.f", "2024-01-31T23:59:59"),
        ("r1", "p", "p.f", "2024-01-31T00:00:00"),
        ("r2", "p", "p.f", "2024-02-01T00:00:00"),
        ("r2", "q", "q.g", "2024-02-01T12:00:00"),
        ("r2", "q", "q.g", None),
    ]
    df = spark.createDataFrame(data, "repo string, library string, symbol_called string, time string")
    return df.select(
        "repo",
        "library",
        F.col("symbol_called").alias("symbol"),
        "symbol_called",
        F.to_timestamp("time").alias("event_time"),
    )


def test_daily_usage_drops_null_times(spark):
    assert rows(ul.daily_usage(events(spark))) == [
        ("p", "p.f", 1, at("2024-02-01"), at("2024-02-02")),
        ("p", "p.f", 2, at("2024-01-31"), at("2024-02-01")),
        ("q", "q.g", 1, at("2024-02-01"), at("2024-02-02")),
    ]


def test_monthly_usage_and_roll_ups_agree(spark):
    expected = [
        ("r1", "p.f", at("2024-01-01"), 2),
        ("r2", "p.f", at("2024-02-01"), 1),
        ("r2", "q.g", at("2024-02-01"), 1),
    ]
    assert rows(ul.monthly_usage(events(spark))) == expected
    days = ul.daily_usage(events(spark), REPO_KEYS)
    assert rows(ul.months_of_days(days)) == expected
    assert rows(ul.library_days(days)) == rows(ul.daily_usage(events(spark)))


DEPRECATED = "symbol string, library string, deprecated_in string, removed_in string, severity int, replacement string"


def usage(spark):
    data = [("r1", "p.f", 3), ("r1", "q.g", 2), ("r2", "p.f", 1), ("r2", "none", 9), ("r2", None, 4)]
    df = spark.createDataFrame(data, "repo string, symbol_called string, usage_count long")
    return df.select("repo", "symbol_called", F.lit(at("2024-01-01")).alias("time_window"), "usage_count")


def test_scores(spark):
    listed = [("p.f", "p", "1", "2", 4, "p.h"), ("q.g", "q", "1", "2", None, None), (None, "n", "1", "2", 5, None)]
    scored = ul.deprecated_usage(usage(spark), spark.createDataFrame(listed, DEPRECATED))
    assert scored.columns == [
        "repo",
        "symbol_called",
        "time_window",
        "usage_count",
        "deprecated_in",
        "removed_in",
        "severity",
        "replacement",
        "exposure_score",
    ]
    assert rows(scored, "repo", "symbol_called", "severity", "exposure_score") == [
        ("r1", "p.f", 4, 12),
        ("r1", "q.g", 1, 2),
        ("r2", "p.f", 4, 4),
    ]
    assert rows(ul.repo_exposure(scored)) == [
        ("r1", at("2024-01-01"), 14, 5, 2),
        ("r2", at("2024-01-01"), 4, 1, 1),
    ]


def test_symbol_listed_twice_counts_twice(spark):
    listed = [("p.f", "p", "1", "2", 4, "a"), ("p.f", "p", "1", "3", 1, "b")]
    listed = spark.createDataFrame(listed, DEPRECATED)
    exposed = ul.repo_exposure(ul.deprecated_usage(usage(spark), listed))
    assert rows(exposed, "repo", "exposure_score", "total_deprecated_calls", "unique_deprecated_apis") == [
        ("r1", 15, 6, 1),
        ("r2", 5, 2, 1),
    ]
    assert rows(ul.repeated_symbols(listed)) == [("p.f", 2)]


def test_exposure_is_linear_in_severity(spark):
    def total(factor):
        listed = [("p.f", "p", "1", "2", 2 * factor, None), ("q.g", "q", "1", "2", 5 * factor, None)]
        scored = ul.deprecated_usage(usage(spark), spark.createDataFrame(listed, DEPRECATED))
        return {r.repo: r.exposure_score for r in ul.repo_exposure(scored).collect()}

    assert total(3) == {repo: 3 * score for repo, score in total(1).items()}


def test_list_past_the_broadcast_limit_gives_the_same_scores(spark):
    listed = [("p.f", "p", "1", "2", 4, "a"), ("p.f", "p", "1", "3", 1, "b"), ("q.g", "q", "1", "2", 2, None)]
    listed = spark.createDataFrame(listed, DEPRECATED)
    expected = rows(ul.deprecated_usage(usage(spark), listed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(ul.deprecated_usage(usage(spark), listed)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
