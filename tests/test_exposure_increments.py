"""Exposure that is added to, against exposure computed from all usage."""

import datetime as dt
import random

import pytest

from tests.conftest import rows
from usagelens.operators.exposure import add_codes, exposure_parts, repo_exposure
from usagelens.plans.exposure import add_exposure, compact_exposure, stored_exposure

SCORED = "repo string, symbol_called string, time_window timestamp, usage_count long, exposure_score long"


def scores(spark, seed, count, symbols):
    pick = random.Random(seed)
    data = [
        (
            pick.choice(["hot", "hot", "a", "b", None]),
            pick.choice(symbols),
            dt.datetime(2024, pick.randint(1, 3), 1),
            pick.randint(1, 9),
            pick.randint(1, 50),
        )
        for _ in range(count)
    ]
    return spark.createDataFrame(data, SCORED)


def test_increments_equal_all_usage(spark, tmp_path):
    path, every = str(tmp_path / "state"), None
    symbols = [f"p.f{i}" for i in range(300)]
    for number in range(4):
        part = scores(spark, number, 300, symbols[: 100 * number + 50])
        every = part if every is None else every.unionByName(part)
        add_exposure(part, path, number)
        assert rows(stored_exposure(spark, path)) == rows(repo_exposure(every))
    add_exposure(part, path, 3)  # a retry of the last one
    assert rows(stored_exposure(spark, path)) == rows(repo_exposure(every))
    with pytest.raises(ValueError, match="increment 1"):
        add_exposure(part, path, 1)
    copied = str(tmp_path / "copied")
    compact_exposure(spark, path, copied)
    more = scores(spark, 9, 100, symbols)
    add_exposure(more, copied, 4)
    assert rows(stored_exposure(spark, copied)) == rows(repo_exposure(every.unionByName(more)))


def test_codes_are_dense_and_stay(spark):
    names = spark.range(1000).selectExpr("concat('s', id % 700) as symbol").repartition(7)
    first = add_codes(spark.createDataFrame([], "symbol string, code long"), names).cache()
    assert sorted(r.code for r in first.collect()) == list(range(1, 701))
    more = spark.createDataFrame([("s1",), ("new",), (None,), ("new",)], "symbol string")
    assert rows(add_codes(first, more)) == [("new", 701)]
    assert add_codes(first, more.limit(0)).count() == 0


def test_symbols_beyond_one_bitmap(spark):
    """Codes in several ranges: each has its own row, and counts add up."""
    codes = spark.range(70_000).selectExpr("concat('s', id) as symbol", "id + 1 as code")
    usage = codes.selectExpr(
        "'r' as repo", "symbol as symbol_called", "timestamp'2024-01-01' as time_window",
        "1L as usage_count", "2L as exposure_score",
    )
    parts = exposure_parts(usage.unionByName(usage), codes)
    assert parts.count() == 3
    total = parts.selectExpr("sum(bitmap_count(symbols))", "sum(calls)", "sum(exposure_score)").first()
    assert tuple(total) == (70_000, 140_000, 280_000)


def test_no_usage(spark, tmp_path):
    path = str(tmp_path / "state")
    assert stored_exposure(spark, path).count() == 0
    add_exposure(spark.createDataFrame([], SCORED), path, 0)
    assert stored_exposure(spark, path).count() == 0
