import random

import numpy as np

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm.quality_model import fit, grade_documents


def loss(ids, bounds, grades, n, weights, cuts):
    out = 0.0
    for i, g in enumerate(grades):
        score = weights[ids[bounds[i] : bounds[i + 1]]].mean()
        upto = lambda j: 1 / (1 + np.exp(score - cuts[j])) if 0 <= j < n - 1 else float(j >= 0)
        out -= np.log(upto(g) - upto(g - 1))
    return out / len(grades)


def test_fit_orders_thresholds_and_lowers_the_loss():
    draw = np.random.default_rng(3)
    grades = np.repeat([0, 1, 2, 3], 50)
    ids = np.concatenate([draw.integers(0, 8, 20) + 4 * g for g in grades]).astype(np.int32)
    bounds = np.arange(201) * 20
    start = loss(ids, bounds, grades, 4, np.zeros(32), np.log([1 / 3, 1, 3]))
    weights, cuts = fit(ids, bounds, grades, 4, buckets=32)
    assert (np.diff(cuts) > 0).all()
    assert loss(ids, bounds, grades, 4, weights, cuts) < 0.5 * start
    # At the end small changes of either kind no longer help.
    best = loss(ids, bounds, grades, 4, weights, cuts)
    for k in range(3):
        moved = cuts.copy()
        moved[k] += 0.3
        assert loss(ids, bounds, grades, 4, weights, moved) > best


def rated(spark):
    pick = random.Random(6)
    names = [f"n{i}" for i in range(200)]
    data, ratings = [], []
    for i in range(300):
        grade = i % 3
        text = " ".join(pick.choices(names, k=30) + ["fine!!"] * (10 * grade))
        data.append((i, text))
        if i % 5:
            ratings.append((i, grade))
    return data, spark.createDataFrame(ratings, "doc_id long, grade int")


def test_held_out_grades(spark, documents):
    data, ratings = rated(spark)
    found = {r.id: r for r in grade_documents(documents(data), ratings, sample_rows=100).collect()}
    held = [r for i, r in found.items() if i % 5 == 0]
    assert sum(round(r.expected_grade) == r.id % 3 for r in held) >= 0.95 * len(held)
    assert all((r.tail_probability > 0.5) == (r.id % 3 > 0) for r in held)
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in found.values())


def test_messy_rows_and_no_ratings(spark, documents):
    _, ratings = rated(spark)
    found = grade_documents(documents(MESSY), ratings)
    assert rows(found, "id") == sorted([(i,) for i, _ in MESSY], key=repr)
    assert found.filter("expected_grade is null or tail_probability is null").count() == 0
    none = grade_documents(documents(MESSY), ratings.limit(0))
    assert {round(r.expected_grade, 6) for r in none.collect()} == {1.0}
    assert grade_documents(documents(MESSY).limit(0), ratings).count() == 0


def plain_features(text, buckets):
    """Feature numbers of a text, word by word."""
    import re

    import xxhash

    number = lambda name: xxhash.xxh64_intdigest(name) % buckets
    out, before = [], None
    for word in (text or "").encode().split():
        name = word.decode()
        shape = re.sub(r"\d+", "0", name)
        shape = re.sub(
            r"[^\W\d_]+",
            lambda m: "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a",
            shape,
        )
        shape = re.sub(r"(.)\1+", r"\1", shape)
        out += [number(f"w {name.lower()}"), number(f"s {shape}")]
        if word == before:
            out.append(number(f"again {len(name) > 3}"))
        before = word
    return out


def test_scores_equal_plain_ones(spark, documents):
    """Features, the fit on all rated texts and scores, recomputed in plain Python."""
    pick = random.Random(4)
    good = ["Plain", "words,", "in", "order.", "Numbers", "2024", "and", "more"]
    bad = ["BUY", "now!!!", "$$$", "click", "click", "FREE", "aa", "aa"]
    data, ratings = [], []
    for i in range(150):
        grade = pick.choice([0, 1, 2])
        source = {0: bad, 1: good + bad, 2: good}[grade]
        data.append((i, " ".join(pick.choices(source, k=pick.randint(5, 40)))))
        if i % 3:
            ratings.append((i, grade))
    data += [(500, ""), (501, None), (502, "Never seen words")]
    rated = spark.createDataFrame(ratings, "doc_id long, grade int")
    found = {r.id: r for r in grade_documents(documents(data), rated, buckets=512).collect()}
    text = dict(data)
    listed = [plain_features(text[i], 512) for i, _ in ratings]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
    ids = np.array([f for x in listed for f in x], np.int32)
    weights, cuts = fit(ids, bounds, np.array([g for _, g in ratings]), 3, 512)
    for i, t in data:
        own = plain_features(t, 512)
        score = sum(weights[f] for f in own) / len(own) if own else 0.0
        above = [1 / (1 + np.exp(c - score)) for c in cuts]
        assert abs(found[i].expected_grade - sum(above)) < 0.01, i
        assert abs(found[i].tail_probability - above[0]) < 0.01, i
