import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm.packing import (
    Tokens,
    added_tokens,
    pack,
    pack_documents,
    pack_histogram,
    token_pieces,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_the_tokenizer(tokenizer):
    pick = random.Random(4)
    marks = ["a", "Word", "don't", "'s", "42", " ", "  ", "\n", "\n\n ", "\t", "é", "漢字", "!!", " "]
    marks += ["　", "<|endoftext|>", "\0", "\x1c", "🙂", "​", "\x85", "_", "'", "ll"]
    tokens = Tokens(RANKS)
    for text in [t for _, t in MESSY if t] + ["".join(pick.choices(marks, k=30)) for _ in range(3000)]:
        assert tokens.encode(text).tolist() == plain_ids(tokenizer, text), text


@pytest.mark.parametrize("seed", range(20))
def test_histogram_is_packed_whole(seed):
    pick = random.Random(seed)
    capacity = pick.choice([8, 100, 1024])
    histogram = {n: pick.randint(1, 1000) for n in pick.sample(range(1, capacity + 1), min(capacity, 60))}
    used, packs = dict.fromkeys(histogram, 0), 0
    for pattern, count, fill in pack_histogram(histogram, capacity):
        assert sum(n * uses for n, uses in pattern.items()) == fill <= capacity
        packs += count
        for n, uses in pattern.items():
            used[n] += uses * count
    assert used == histogram
    tokens = sum(n * c for n, c in histogram.items())
    # Two packs half full or less would have been one.
    assert packs <= 2 * tokens / capacity + 1


def test_pieces_are_whole_and_sequences_gapless(documents, tokenizer):
    docs = documents(MESSY)
    found = pack_documents(docs, RANKS, capacity=64).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.id, []).append(r)
    for doc_id, text in MESSY:
        if doc_id in (None, 6):
            continue
        ids, at = np.array(plain_ids(tokenizer, text) + [0], "<u4"), 0
        for r in sorted(by_id[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_documents(docs.limit(0), RANKS).count() == 0
    pieces = token_pieces(docs, RANKS, capacity=64)
    assert pieces.filter("octet_length(ids) != width * length").count() == 0
    assert pieces.count() == len(found)


def test_pack_keeps_other_columns(spark):
    table = spark.range(500).selectExpr("id", "id % 7 + 1 as length", "id as rank", "id as part")
    found = pack(table, ["id"], capacity=10)
    assert found.columns == ["id", "length", "rank", "part", "sequence_id", "offset"]
    assert sorted(rows(found, "id", "part")) == [(i, i) for i in range(500)]
    fill = found.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 10


@pytest.fixture(scope="module")
def as_loaded():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def special_texts():
    pick = random.Random(6)
    marks = ["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "  ", "\n", "a", "Word", "é", "'s", "\0"]
    return ["x<|endoftext|>", "<|endoftext|>" * 3] + ["".join(pick.choices(marks, k=12)) for _ in range(2000)]


def test_added_tokens_have_their_ids(as_loaded):
    tokens = Tokens(RANKS, added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    assert tokens.encode("x<|endoftext|>").tolist() == [87, 50256]
    for text in special_texts():
        assert tokens.encode(text).tolist() == plain_ids(as_loaded, text), text


def test_query_and_stage_know_added_tokens(spark, as_loaded, tmp_path):
    import corpus_pipeline
    from usagelens.llm.queries import QUERIES

    data = list(enumerate(special_texts()[:50]))
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expect = {i: np.array(plain_ids(as_loaded, t) + [0], "<u4").tobytes() for i, t in data}
    for found in (QUERIES["op3_packing"](spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, "")):
        found = {r.doc_id: r for r in found.collect()}
        assert {i: r.ids_crc32 for i, r in found.items()} == {i: zlib.crc32(x) for i, x in expect.items()}
        assert {i: r.doc_tokens for i, r in found.items()} == {i: len(x) // 4 for i, x in expect.items()}


def test_sequences_hold_the_ids_of_all_documents(spark, documents, as_loaded):
    """Equal rows included: put together again, the pieces are the documents' ids."""
    import corpus_pipeline

    data = MESSY + [(12, "equal " * 3000)] * 3
    found = corpus_pipeline.packing(spark, documents(data), "").collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in found)
    expect = []
    for i, text in data:
        ids = np.array(plain_ids(as_loaded, text) + [0], "<u4")
        expect += [(i, at, ids[at : at + 1024].tobytes()) for at in range(0, len(ids), 1024)]
    assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in found), key=repr) == sorted(expect, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += len(ids) // 4
        assert at <= 1024


def test_long_gaps_and_texts(tokenizer, monkeypatch):
    """Runs of white space around and beyond what is encoded apart, and texts cut into parts."""
    from usagelens.llm import packing

    monkeypatch.setattr(packing, "_LONG", 0)
    tokens = Tokens(RANKS)
    for gap in (" ", "\t", " \n", "　", "\xa0 "):
        for n in (127, 255, 256, 257, 600):
            for text in ("a" + gap * n + "b", gap * n, gap * n + "c.", "x" + gap * n, f"a{gap * n}\tb {gap * n}c"):
                assert tokens.encode(text).tolist() == plain_ids(tokenizer, text), (gap, n)
    monkeypatch.setattr(packing, "_TEXT", 100)
    pick = random.Random(2)
    text = "".join(pick.choices(["word ", "x, ", "  ", "\n", "é ", "'s ", " "], k=5000))
    assert tokens.encode(text).tolist() == plain_ids(tokenizer, text)
    assert len(tokens.encode(" " * 3_000_000)) > 0


def test_pieces_of_many_batches(documents, tokenizer, monkeypatch):
    """Pieces leave in several record batches, cut at the capacity."""
    from usagelens.llm import packing

    monkeypatch.setattr(packing, "_PIECES_AT_ONCE", 3)
    import pyarrow as pa
    from array import array

    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3], "x": [4, 5, 6], "id": [7, 8, 9]})
    encoded = [array("H", range(n)) for n in (1, 25, 10)]
    found = [r for b in packing._cut(batch, 0, encoded, 2, 5) for r in b.to_pylist()]
    assert [(r["id"], r["start"], r["length"]) for r in found] == [
        (7, 0, 1), *[(8, s, 5) for s in range(0, 25, 5)], (9, 0, 5), (9, 5, 5)
    ]
    for r in found:
        ids = np.frombuffer(r["ids"], "<u2")
        assert ids.tolist() == list(range(r["start"], r["start"] + r["length"]))
