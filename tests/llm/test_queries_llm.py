"""The registered queries on the smallest tables: against SQL where there is any, else against
plain Python over the same rows."""

import importlib.util
import os
import zlib
from collections import Counter
from hashlib import sha256
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tests.llm import test_language_model as plain_model
from tests.llm import test_periodic_runs as plain_runs
from tests.llm import test_quality_rules as plain_rules
from tests.llm import test_simhash as plain_prints
from tests.llm import test_substring_dedup as plain_passages
from tests.llm.conftest import words
from usagelens.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, SF_DIR).collect()}


def test_entry_registers_all():
    path = Path(__file__).parents[2] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_llm", path)
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.ORACLE_SQL) < set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    expected = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    mine = sorted(tuple(r[c] for c in columns) for r in found.collect())
    at = [expected.columns.index(c) for c in columns]
    assert mine == sorted(tuple(r[i] for i in at) for r in expected.fetchall())


def test_substrings(spark, texts):
    found = run(spark, "op1_substring_dedup")
    expect = plain_passages.expected([t for _, t in texts], 35)
    for (i, _), (n, removed, kept) in zip(texts, expect, strict=True):
        assert (found[i].n_words, found[i].n_removed) == (n, removed)
        assert found[i].kept_sha256 == sha256(kept.encode()).hexdigest()


def test_packing(spark, texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = queries.QUERIES["op3_packing"](spark, SF_DIR).collect()
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        padding += 1024 - at
    assert padding < 0.05 * 1024 * len(by_sequence)


def test_language_model(spark, texts):
    found = run(spark, "op6_language_model")
    training = [r for r in texts if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    n, expect = plain_model.base_scores(texts, training)
    for i, text in texts:
        size, known, base = expect[i, text]
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-6)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_quality_rules_query(spark, texts):
    found = run(spark, "op8_quality_rules")
    for i, text in texts:
        r, expect = found[i], plain_rules.plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expect
        assert r.base_failed == (expect[0] < 10 or 100 * expect[4] > 20 * expect[0])
        assert not (r.base_failed and r.kept)


def test_simhash_query(spark, texts):
    found = run(spark, "op9_simhash")
    prints = {i: plain_prints.plain_simhash(t) for i, t in texts}
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == prints
    root = plain_prints.roots(set(prints.values()))
    least = {}
    for i, p in sorted(prints.items(), reverse=True):
        least[root[p]] = i
    assert {i: r.component_id for i, r in found.items()} == {i: least[root[p]] for i, p in prints.items()}


def test_runs_query(spark, texts):
    found = run(spark, "op11_periodic_runs")
    hit = 0
    for i, text in texts:
        x = words(text)
        h, n = zlib.crc32(str(i).encode()), len(x)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [x[j] if j < a else x[a + (j - a) % p] for j in range(n)]
        runs, kept = plain_runs.plain(x)
        hit += bool(runs)
        best = min(((-m, s, q) for s, m, q in runs), default=(None, None, None))
        r = found[i]
        assert r.n_runs == len(runs)
        if runs:
            assert (r.length, r.start, r.period) == (-best[0], *best[1:])
            assert r.exponent_milli == 1000 * r.length // r.period
        else:
            assert (r.length, r.start, r.period, r.exponent_milli) == (None,) * 4
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(kept.encode()).hexdigest()
    assert hit > 10 and len(found) == len(texts)


def test_bpe_query(spark, texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = run(spark, "op12_bpe")
    for i, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        r = found[i]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == sha256(decoded.encode()).hexdigest()


def test_classifiers_on_labelled_rows(spark, duck):
    labels = {i: (q, t) for i, q, t in duck.sql("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    graded, toxic = run(spark, "op2_quality_classifier"), run(spark, "op10_toxicity")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic.values())
    right = [graded[i].kept == bool(q) for i, (q, _) in labels.items() if graded[i].held_out]
    assert sum(right) > 0.85 * len(right)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in toxic.items())


def test_nothing_is_lost(spark, texts):
    for name in ("op2_quality_classifier", "op7_line_dedup", "op10_toxicity"):
        found = Counter(r.doc_id for r in queries.QUERIES[name](spark, SF_DIR).collect())
        assert found == Counter(i for i, _ in texts)
    assert words(" a\tb ") == [b"a", b"b"]
