import random
from collections import defaultdict

import pytest

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm.line_dedup import drop_boilerplate, spread_lines

BLANK = " \t\n\x0b\x0c\r"


def expected(data, min_sites):
    sites = defaultdict(set)
    for _, text, source in data:
        for line in (text or "").split("\n"):
            sites[line.strip(BLANK)].add(source)
    out = []
    for i, text, _ in data:
        lines = (text or "").split("\n")
        worded = [x for x in lines if x.strip(BLANK)]
        gone = [x for x in worded if len(sites[x.strip(BLANK)]) >= min_sites]
        kept = [x for x in lines if x not in gone]
        out.append((i, len(worded), len(gone), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [0, 1000])
def test_equals_counting_sites(documents, most):
    pick = random.Random(most)
    lines = [f"line {i}" for i in range(40)] + ["", "  ", "\t line 3 "]
    data = [
        (i, "\n".join(pick.choices(lines, k=pick.randint(0, 6))), f"s{pick.randint(0, 30)}" if i % 9 else None)
        for i in range(300)
    ]
    found = drop_boilerplate(documents(data), min_sites=15, max_broadcast_lines=most)
    assert rows(found) == expected(data, 15)
    assert any(row[2] for row in expected(data, 15)) and any(row[1] > row[2] for row in expected(data, 15))


def test_far_and_near_of_the_threshold(spark):
    """Lines on 1 to 400 sites; the threshold lies between two of them."""
    table = spark.range(400).selectExpr("id as h1", "cast(id as int) as h2", "explode(sequence(0, id)) as s")
    table = table.selectExpr("h1", "h2", "cast(s as string) as site")
    found = spread_lines(table.unionByName(table), 200)
    assert {r.h1 for r in found.collect()} == set(range(199, 400))


def test_messy_rows(documents):
    data = [(*row, "s") for row in MESSY]
    assert rows(drop_boilerplate(documents(data))) == expected(data, 10)
    assert drop_boilerplate(documents(MESSY).limit(0)).count() == 0
    assert rows(drop_boilerplate(documents(data), min_sites=1), "n_removed") == sorted(
        [(r[2],) for r in expected(data, 1)], key=repr
    )


def test_many_lines_take_linear_time(spark, documents):
    """Ten equal texts of boilerplate: four times the lines, not sixteen times the time."""
    import time

    def seconds(lines):
        text = "\n".join(f"line {i}" if i % 7 else f"own {i}" for i in range(lines))
        texts = [(i, text.replace("own", f"own {i} of"), f"s{i}") for i in range(10)]
        docs = documents(texts).cache()
        docs.count()
        start = time.monotonic()
        found = drop_boilerplate(docs, min_sites=10).collect()
        took = time.monotonic() - start
        assert all(r.n_lines == lines and r.n_removed == lines - -(-lines // 7) for r in found)
        assert all(r.kept.split("\n") == [f"own {r.id} of {i}" for i in range(0, lines, 7)] for r in found)
        return took

    seconds(100)
    assert seconds(40_000) < 5 * max(seconds(10_000), 1.5)
