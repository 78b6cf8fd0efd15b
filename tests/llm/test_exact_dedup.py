import hashlib
import random

import numpy as np
import pytest

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm import exact_dedup
from usagelens.llm.exact_dedup import combine, drop_exact_copies, exact_groups, fingerprint


def expected(data):
    groups = {}
    for doc_id, text, *_ in data:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def found(groups):
    out = []
    for r in groups.collect():
        out += [(r.id, r.keep_id, r.group_size, r.sha256)] * r.copies
    return sorted(out, key=repr)


def test_fingerprints_of_parts_combine():
    powers = exact_dedup._block_powers(exact_dedup.PRIMES)
    data = np.random.default_rng(1).integers(0, 256, 50_000).astype(np.uint8)
    whole = fingerprint(data, powers)
    for cut in (0, 1, 16_384, 20_001, 50_000):
        left, right = fingerprint(data[:cut], powers), fingerprint(data[cut:], powers)
        assert combine(left, right, 50_000 - cut) == whole
    plain = 0
    for byte in data[:2000].tolist():
        plain = (plain * 69069 + byte + 1) % exact_dedup.PRIMES[0]
    assert fingerprint(data[:2000], powers)[0] == plain
    assert fingerprint(np.zeros(1, np.uint8), powers) != fingerprint(np.zeros(2, np.uint8), powers)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (3, 2)])
def test_groups_equal_those_of_the_texts(spark, documents, primes):
    """With tiny primes nearly all fingerprints collide; the comparison tells the texts apart."""
    pick = random.Random(3)
    data = MESSY + [(i, pick.choice(["ab", "ba", "cc", "abc" * 9])) for i in range(20, 60)]
    docs = documents(data)
    groups = exact_groups(docs, primes=primes, chunk_bytes=8, members_per_copy=3)
    assert found(groups) == expected(data)
    kept = {r.id for r in groups.filter("kept").collect()}
    assert kept == {keep for _, keep, _, _ in expected(data)}


def test_segments_do_not_change_fingerprints(documents):
    docs = documents(MESSY)
    names = ["id", "f0", "f1", "f2", "f3", "copies"]
    whole = rows(exact_dedup.fingerprints(docs), *names)
    assert rows(exact_dedup.fingerprints(docs, segment_bytes=1000), *names) == whole
    assert (6, 2) in {(r[0], r[-1]) for r in whole}


def test_one_row_of_each_group_stays_with_its_columns(documents):
    docs = documents(MESSY)
    stay = drop_exact_copies(docs)
    assert stay.columns == docs.columns
    assert rows(stay, "doc_id") == sorted([(1 * i,) for i in (3, 5, 6, 8, 9, 11)] + [(None,)], key=repr)
    assert stay.filter("doc_id = 6 and kept = 'extra'").count() == 1
    assert drop_exact_copies(docs.limit(0)).count() == 0
    assert exact_groups(documents([(None, "a"), (None, "a")])).filter("kept").count() == 1
