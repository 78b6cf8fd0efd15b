import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def plain(data, min_docs=10, top=10):
    """Rows of the result, from (text, lang, source), densely over all terms and groups."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in data:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, d in docs[lang].items() if d >= min_docs)
        every = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        every[None] = {t: sum(every[s][t] for s in sources) for t in kept}
        share = {
            s: {t: 1 + 10**9 * (c + 2) // (sum(own.values()) + 2 * len(kept)) for t, c in own.items()}
            for s, own in every.items()
        }
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(gap(share[s][t], share[o][t]) for t in kept)) for o in sources - {s}]
            above = [
                (t, gap(share[s][t], share[None][t]))
                for t in kept
                if every[s][t] and share[s][t] > share[None][t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", above, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def table(spark):
    schema = "text string, lang string, source string, term string, g long, path string, c long"
    return lambda data: spark.createDataFrame([(*r, "x", 1, "y", 2) for r in data], schema)


@pytest.mark.parametrize("seed", range(3))
def test_equals_dense_sums(table, seed):
    pick = random.Random(seed)
    vocabulary = [f"w{c}" for c in "abcdefghijklmnopqrstuv"] + ["Größe", "naïve", "A", "漢字"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    data = []
    for _ in range(400):
        text = " ".join(pick.choices(vocabulary, weights, k=pick.randint(0, 12)))
        lang = pick.choice(["en", "en", "de", "few", None])
        data.append((text, lang, pick.choice(["hot"] * 5 + list("abcdefg") + [None, ""])))
    data += [("rare words only", "none", s) for s in "ab"] + [(None, "alone", "x"), ("", None, None)]
    assert rows(dv.source_divergence(table(data))) == plain(data)
    assert rows(dv.source_divergence(table(data), min_docs=1, top=3)) == plain(data, 1, 3)


def test_nodes_count_terms_once_per_path():
    paths = [(1,), (1, 2), (1, 2, 3), (1, 2, 4), (1, 3), (2,), (2, 3, 4)]
    times = np.array([5, 1, 2, 3, 4, 7, 9])
    lengths = np.array([len(p) for p in paths])
    bounds = np.cumsum(lengths) - lengths
    keys = np.array([x for p in paths for x in p])[:, None]
    found = Counter()
    for depth, at, n in dv.tree_nodes(lengths, bounds, keys, times):
        for row, m in zip(at.tolist(), n.tolist()):
            assert paths[row][: depth + 1] not in found
            found[paths[row][: depth + 1]] = m
    expect = Counter()
    for p, m in zip(paths, times.tolist()):
        for end in range(1, len(p) + 1):
            expect[p[:end]] += m
    assert found == expect


def test_pieces_of_texts_and_flushes(monkeypatch, table, spark):
    """Counts are the same if texts are cut into small pieces and sums leave a task early."""
    pick = random.Random(8)
    data = [
        (" ".join(pick.choices(["aa", "bb,", "Cc-dd", "é"], k=40)), "en", pick.choice("xyz"))
        for _ in range(60)
    ]
    text = data[0][0].encode()
    monkeypatch.setattr(dv, "_PIECE", 7)
    found = [t for part in dv._terms(text) for t in part]
    assert [t.decode() for t in found] == terms(data[0][0])
    assert all(len(part) <= 7 for part in dv._terms(text))


def test_messy_rows(table):
    data = [(t, lang, s) for _, t in MESSY for lang, s in (("en", "a"), ("en", None), (None, "b"))] * 4
    assert rows(dv.source_divergence(table(data))) == plain(data)
    assert dv.source_divergence(table(data).limit(0)).count() == 0


def test_shares_of_large_counts(spark):
    cases = [(2, 10**15), (10**15, 10**15), (123_456_789_012_345, 9 * 10**14), (2, 0), (7, 9)]
    table = spark.createDataFrame(cases, "a long, b long")
    found = table.select("a", "b", dv._share(table.a, table.b).alias("p")).collect()
    assert all(r.p == (1 + 10**9 * r.a // r.b if r.b else 1) for r in found)
