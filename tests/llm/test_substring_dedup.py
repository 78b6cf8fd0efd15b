import random
from collections import Counter

import pytest

from tests.llm.conftest import MESSY, words
from usagelens.llm.substring_dedup import repeated_passages, squeeze, unsqueeze


def expected(texts, size):
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        out.append((len(w), sum(gone), kept))
    return out


@pytest.mark.parametrize("size", [6, 7])
@pytest.mark.parametrize("group_bytes", [200, 1 << 20])
def test_equals_counting_all_windows(documents, size, group_bytes):
    """Short words from a few, so that repeats of any length, place and overlap occur."""
    pick = random.Random(size)
    texts = [" ".join(pick.choices("abc", k=pick.randint(0, 40))) for _ in range(60)]
    passage = " ".join(f"w{i}" for i in range(30))
    texts += [f"{pick.random()} {passage[: pick.randint(20, 90)]} end" for _ in range(40)]
    texts += [text for _, text in MESSY if len(text or "") < 1000]
    docs = documents(list(enumerate(texts)))
    found = repeated_passages(docs, size=size, group_bytes=group_bytes, bucket_windows=64)
    found = {r.id: (r.n_words, r.n_removed, r.kept, r.removed) for r in found.collect()}
    for i, (n, removed, kept) in enumerate(expected(texts, size)):
        assert found[i][:3] == (n, removed, kept)
        assert sum(r.end - r.first for r in found[i][3]) == removed
    assert any(removed for _, removed, _ in expected(texts, size))


def test_messy_rows(documents):
    found = repeated_passages(documents(MESSY)).collect()
    expect = expected([text for _, text in MESSY], 35)
    assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in found) == Counter(
        (i, *e) for (i, _), e in zip(MESSY, expect, strict=True)
    )
    assert repeated_passages(documents(MESSY).limit(0)).count() == 0


def test_repeated_rows_count_as_places(documents):
    text = " ".join(f"w{i}" for i in range(40))
    assert [r.n_removed for r in repeated_passages(documents([(1, text), (1, text)])).collect()] == [40, 40]
    assert repeated_passages(documents([(1, text)])).first().n_removed == 0


def test_squeezed_numbers_come_back():
    import numpy as np

    for width in (4, 8):
        values = np.sort(np.random.default_rng(2).integers(0, 1 << (8 * width - 1), 500).astype(np.uint64))
        assert (unsqueeze(squeeze(values, width), width) == values).all()
    assert len(unsqueeze(b"", 8)) == 0
