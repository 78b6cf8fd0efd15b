import json
import os
import random

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import MESSY
from usagelens.llm import bpe

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a", "b", "the", "in", "ing", "er", "é", "ß", "Σ", "İ", "漢", "😀", "'s", "'LL", " ", "\x1c", "\x85",
    "<|endoftext|>", "<|startoftext|>", "<", "|", "1", "23", "½", "²", "µ", "ª", "́", "!!", "...",
    "zz", "Ã", "\x00", "​", "﻿", "ẞ", "ﬁ", "Å", "\n", "\t", "\xa0", " ", "　", "_",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH, most=500)  # small, so that words are forgotten and made again


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def merged(ranks, symbols):
    """Plain BPE: the pair of least rank merges, the one furthest left of equal ones."""
    parts = list(symbols)
    while True:
        every = [(ranks.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not every or min(every)[0] == 1 << 30:
            return parts
        i = min(every)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_small_vocabulary_against_plain_merging():
    pick = random.Random(3)
    for _ in range(40):
        letters = "ab"
        tokens = [*letters, *(x + "</w>" for x in letters)]
        merges = []
        for _ in range(200):
            a, b = pick.choice(tokens), pick.choice(tokens)
            if not a.endswith("</w>") and a + b not in tokens and len(a + b) < 14:
                tokens.append(a + b)
                merges.append((a, b))
        model = {
            "type": "BPE", "end_of_word_suffix": "</w>", "vocab": {t: i for i, t in enumerate(tokens)},
            "merges": [list(m) for m in merges],
        }
        table = bpe.Merges(model)
        ranks = {m: i for i, m in enumerate(merges)}
        reached = {t for t in tokens if merged(ranks, [*t.removesuffix("</w>")[:-1], *(
            [t.removesuffix("</w>")[-1] + t[len(t.removesuffix("</w>")) :]])]) == [t]}
        assert {i for i, t in enumerate(tokens) if t in reached} == set(table.spelled)
        small = object.__new__(bpe.Encoder)
        import ahocorasick

        small._merges, small._automaton = table, ahocorasick.Automaton()
        small._length = [0] * table.size
        for i, s in table.spelled.items():
            small._automaton.add_word(s, i)
            small._length[i] = len(s)
        small._automaton.make_automaton()
        small._stable = bpe.Remembered(small._pair, 100)
        for _ in range(60):
            word = "".join(pick.choices(letters, k=pick.randint(1, 25)))
            expect = merged(ranks, [*word[:-1], word[-1] + "</w>"])
            found = small.word(word[:-1] + chr(ord(word[-1]) + bpe._LAST))
            assert [tokens[i] for i in found] == expect


def test_random_texts_equal_the_library(encoder, library):
    pick = random.Random(1)
    for letters, most in ((ODD, 14), ("aaaabeinst", 30), ("etaoin' shrdlu", 80), ("éèÀaß1½ ,.", 40)):
        for _ in range(1500):
            text = "".join(pick.choice(letters) for _ in range(pick.randint(0, most)))
            assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_single_characters_equal_the_library(encoder, library):
    every = [*range(0x3100), *range(0xFB00, 0x10000), *range(0x3100, 0x110000, 997)]
    for code in every:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b {chr(code)}"
            assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, hex(code)


def test_long_words_and_texts(monkeypatch, encoder, library):
    monkeypatch.setattr(bpe, "_PIECE", 1000)
    pick = random.Random(9)
    text = "".join(pick.choices("abc é,<\t\n ", k=30_000)) + " " + "ab" * 20_000
    assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_rows_and_round_trip(documents, library):
    rows = [*MESSY, (20, "Hello,  World <|endoftext|> it's 42"), (21, "<|startoftext|>")]
    table = bpe.decode(bpe.encode(documents(rows), PATH), PATH)
    assert table.columns == ["id", "n_tokens", "ids", "decoded"]
    found = sorted(((r.id, r.n_tokens, ids(r.ids), r.decoded) for r in table.collect()), key=repr)
    expect = []
    for i, text in rows:
        own = library.encode(text or "", add_special_tokens=False).ids
        expect.append((i, len(own), own, library.decode(own, skip_special_tokens=False)))
    assert found == sorted(expect, key=repr)
    assert bpe.encode(documents(rows).limit(0), PATH).count() == 0


def test_null_ids_and_kept_columns(spark):
    table = spark.createDataFrame([(1, None), (2, bytearray(b"\x40\x01\x00\x00"))], "decoded2 int, ids binary")
    found = {r.decoded2: r.decoded for r in bpe.decode(table, PATH).collect()}
    assert found[1] == "" and found[2]


def test_other_vocabularies_are_refused():
    with open(PATH, encoding="utf-8") as file:
        model = json.load(file)["model"]
    for change in ({"byte_fallback": True}, {"unk_token": "!"}, {"end_of_word_suffix": None}):
        with pytest.raises(ValueError):
            bpe.Merges(model | change)
