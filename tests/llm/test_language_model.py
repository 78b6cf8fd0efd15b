import math
import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import rows
from tests.llm.conftest import MESSY, words
from usagelens.llm import language_model as lm
from usagelens.llm import recurrent


@pytest.fixture
def params():
    draw = np.random.default_rng(1)
    made = recurrent.start(np.zeros(7), np.zeros((4, 3)), 15, 5)
    return {k: v + draw.normal(0, 0.3, v.shape).astype(np.float32) for k, v in made.items()}


def mean_loss(params, inputs, fresh, state, kinds, member):
    states, _ = recurrent.run(params, inputs, fresh, state)
    flat = states.reshape(-1, states.shape[2])
    own, _ = recurrent.log_chances(params, flat, kinds.ravel(), member.ravel())
    return -own.mean()


def test_gradients_equal_differences(params):
    draw = np.random.default_rng(2)
    params = {k: v.astype(np.float64) for k, v in params.items()}
    inputs = draw.integers(0, 15, (6, 3))
    fresh, state = draw.random((6, 3)) < 0.2, draw.normal(0, 1, (3, 5))
    member = draw.integers(-1, 12, (6, 3))
    kinds = np.where(member >= 0, member // 3, draw.integers(4, 7, (6, 3)))
    window = (inputs, fresh, state, kinds, member)
    found, _, loss = recurrent.gradients(params, *window)
    assert loss == pytest.approx(mean_loss(params, *window), rel=1e-4)
    for name, values in params.items():
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in values.shape)
            values[at] += 0.05
            high = mean_loss(params, *window)
            values[at] -= 0.1
            low = mean_loss(params, *window)
            values[at] += 0.05
            assert found[name][at] == pytest.approx((high - low) / 0.1, abs=2e-3)


def test_chances_sum_to_one(params):
    states = np.random.default_rng(3).normal(0, 1, (1, 5)).astype(np.float32)
    total = 0.0
    for member in range(12):
        own, last = recurrent.log_chances(params, states, np.array([member // 3]), np.array([member]))
        total += math.exp(own[0])
    for kind in range(4, 7):
        own, _ = recurrent.log_chances(params, states, np.array([kind]), np.array([-1]))
        total += math.exp(own[0])
    assert own[0] == pytest.approx(last[0], abs=1e-5)
    assert total == pytest.approx(1, abs=1e-5)
    large = {k: v * 200 if k == "class_odds" else v for k, v in params.items()}
    own, last = recurrent.log_chances(large, states, np.array([2]), np.array([-1]))
    odds = states.astype(float) @ large["classes"] + large["class_odds"]
    assert own[0] == pytest.approx(odds[0, 2] - np.logaddexp.reduce(odds[0]), rel=1e-4)


def test_state_is_carried_across_windows(params):
    inputs = np.random.default_rng(4).integers(0, 15, (30, 2))
    fresh = np.zeros((30, 2), bool)
    fresh[0] = True
    whole, _ = recurrent.run(params, inputs, fresh, np.ones((2, 5), np.float32))
    state, parts = np.zeros((2, 5), np.float32), []
    for t in range(0, 30, 7):
        states, _ = recurrent.run(params, inputs[t : t + 7], fresh[t : t + 7], state)
        state = states[-1]
        parts.append(states)
    assert np.allclose(np.concatenate(parts), whole, atol=1e-6)


def test_sliced_products_and_sums_equal_plain_ones():
    draw = np.random.default_rng(5)
    rows_, weights = draw.normal(0, 1, (1000, 33)), draw.normal(0, 1, (2, 33, 97))
    assert np.allclose(recurrent._times(rows_, weights), rows_ @ weights)
    assert np.allclose(recurrent._times(rows_[:9], weights[0]), rows_[:9] @ weights[0])
    assert np.allclose(recurrent._across(rows_, rows_[:, :20]), rows_.T @ rows_[:, :20])
    ids = np.minimum(draw.zipf(1.3, 1000) - 1, 299)  # of some ids more than 16 rows, of some one
    expect = np.zeros((300, 33))
    np.add.at(expect, ids, rows_)
    assert np.allclose(recurrent._sums(rows_, ids, 300), expect)


def test_codes_of_texts():
    vocabulary = lm.Vocabulary([(w, 1) for w in (b"and", "ß".encode(), b"zoo", b"\0")])
    spaces = "".join(map(chr, range(1, 256)))  # only space and tab to carriage return divide
    texts = ["And zoo\vzo\u00a0and", None, "", " \r\n ", "zoo", "ß \0\u0085 \0 É é", spaces]
    rank = {w: i for i, w in enumerate(vocabulary.rank)}
    plain = [[w.lower() for w in words(t)] for t in texts]
    filled = pa.array(["left out", *texts]).slice(1).fill_null("")
    codes, lengths, rare = vocabulary.codes(filled)
    expect = [[*(rank.get(w, -1 - vocabulary.other(w)) for w in t), lm._END] for t in plain]
    assert codes.tolist() == sum(expect, [])
    assert lengths.tolist() == list(map(len, expect))
    assert rare.to_pylist() == [w for t in plain for w in t if w not in rank]


def test_long_text_does_not_hold_others_to_few_lanes(params, monkeypatch):
    """One text of 20,000 tokens and 2,000 of 100: most tokens are worked on by many lanes."""
    monkeypatch.setattr(lm, "MEMBERS", 12)
    monkeypatch.setattr(lm, "GROUPS", 4)
    run, worked = recurrent.run, []

    def noting(params, inputs, *rest, **more):
        worked.append(inputs.shape)
        return run(params, inputs, *rest, **more)

    monkeypatch.setattr(recurrent, "run", noting)
    lengths = np.array([100] * 1000 + [20_000] + [100] * 1000)
    stream = np.random.default_rng(6).integers(0, 14, lengths.sum()).astype(np.int32)
    stream[np.cumsum(lengths) - 1] = 14
    own, unknown = lm._logs(params, stream, lengths, 14)
    assert sum(steps * lanes for steps, lanes in worked if lanes >= 200) >= 190_000
    assert sum(steps * lanes for steps, lanes in worked) <= 1.2 * len(stream)
    for first, last in ((0, 100), (100_000, 120_000), (219_900, 220_000)):
        text = stream[first:last]
        before = np.append(14, text[:-1])[:, None]
        states, _ = run(params, before, before == 14, np.zeros((1, 5), np.float32))
        member = np.where(text < 12, text, -1)
        alone = recurrent.log_chances(params, states[:, 0], lm._kinds(text), member)
        assert np.allclose(own[first:last], alone[0], atol=1e-4)
        assert np.allclose(unknown[first:last], alone[1], atol=1e-4)


def tokens(text):
    return [w.lower() for w in words(text)] + [None]


def base_scores(data, training):
    count = Counter(t for _, text in training for t in tokens(text))
    n, v = sum(count.values()), len(count)
    total = math.log10(n + 0.5 * (v + 1))
    return n, {
        (i, text): (
            len(tokens(text)),
            sum(count[t] > 0 for t in tokens(text)),
            sum(math.log10(count[t] + 0.5) for t in tokens(text)) - len(tokens(text)) * total,
        )
        for i, text in data
    }


def two_tongues(n=240):
    """Texts of one of two vocabularies: what comes before tells which."""
    pick = random.Random(8)
    tongues = [[f"{c}{i}" for i in range(80)] for c in "xy"]
    return [(i, " ".join(pick.choices(tongues[i % 2], k=pick.randint(5, 60)))) for i in range(n)]


def test_base_scores_and_gain_on_held_out_texts(documents, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 60)  # most words come by the join
    data = two_tongues() + [(1000 + k, text) for k, (_, text) in enumerate(MESSY)]
    training = [row for row in data if row[0] % 5 != 1]
    found = lm.score_documents(documents(data), documents(training), share=1, lanes=8).collect()
    n, expect = base_scores(data, training)
    text = dict(data)
    for r in found:
        size, known, base = expect[r.id, text[r.id]]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-6)
    held = [r for r in found if r.id % 5 == 1 and r.id < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_messy_and_empty_tables(documents):
    docs = documents(MESSY)
    found = lm.score_documents(docs, docs, rounds=1)
    assert rows(found, "id", "n_tokens") == sorted(((i, len(tokens(t))) for i, t in MESSY), key=repr)
    assert found.filter("not score < 0 or not base_score < 0").count() == 0
    untrained = lm.score_documents(docs, docs.limit(0), rounds=1)
    assert untrained.count() == len(MESSY) and untrained.filter("n_known > 0").count() == 0
    assert lm.score_documents(docs.limit(0), docs, rounds=1).count() == 0


def test_word_counts(documents):
    found = lm.count_words(documents(MESSY + two_tongues(30)))
    expect = Counter(t for _, text in MESSY + two_tongues(30) for t in tokens(text) if t is not None)
    assert {bytes(r.word): r.n for r in found.collect()} == expect
    assert lm.Vocabulary.other(b"abcdef") == 0x616263 % lm.OTHERS
    assert lm.Vocabulary.other(b"a") == 0x61 % lm.OTHERS


def test_word_counts_of_several_pieces(documents, monkeypatch):
    """Counts are added up in a task, and leave it whenever there are more than ``_COUNTS``."""
    monkeypatch.setattr(lm, "_COUNTS", 100)
    data = [(i, text) for i, (_, text) in enumerate(two_tongues(40))] + [(99, "x1 Y2 " * 900_000)]
    found = lm.count_words(documents(data).coalesce(1))
    expect = Counter(t for _, text in data for t in tokens(text) if t is not None)
    assert {bytes(r.word): r.n for r in found.collect()} == expect


def test_every_training_document_trains_by_default(documents, monkeypatch, tmp_path):
    """Each task notes the texts it trains on; the rounds together see each once."""
    train = lm._train

    def noting(*args):
        step = train(*args)

        def run(batches):
            def noted():
                for batch in batches:
                    for text in batch["text"].to_pylist():
                        (tmp_path / uuid.uuid4().hex).write_text(text)
                    yield batch

            yield from step(noted())

        return run

    monkeypatch.setattr(lm, "_train", noting)
    data = two_tongues(60)
    lm.score_documents(documents(data[:1]), documents(data))
    seen = Counter(path.read_text() for path in tmp_path.iterdir())
    assert seen == Counter(text for _, text in data)


def test_no_share_is_left_out(documents):
    with pytest.raises(ValueError):
        lm.score_documents(documents(MESSY), documents(MESSY), rounds=3, share=8)


def test_scores_equal_a_plain_forward_pass(documents, monkeypatch):
    """Members, other words of the head, words that come by the join, and words never seen."""
    monkeypatch.setattr(lm, "HEAD", 4400)
    score, seen = lm._score, []

    def noting(model, vocabulary, sums, total):
        seen.append((model.value, vocabulary.value))
        return score(model, vocabulary, sums, total)

    monkeypatch.setattr(lm, "_score", noting)
    pick = random.Random(12)
    every = [f"{pick.choice('abcdé')}{pick.choice('xyz')}{i}" for i in range(6000)]
    texts = [" ".join(pick.choices(every, k=200)) for _ in range(120)]
    data = list(enumerate([*texts, "", None, " ".join(every[:3000]), "Never seen " + texts[0].upper()]))
    training = data[:100]
    found = {r.id: r for r in lm.score_documents(documents(data), documents(training), rounds=1).collect()}
    ((params, vocabulary),) = seen
    params = {k: v.astype(float) for k, v in params.items()}
    count = Counter(t for _, text in training for t in tokens(text))
    ends = count.pop(None)
    listed = sorted(count, key=lambda w: (-count[w], w))
    assert listed[:4400] == list(vocabulary.rank)
    rank = {w: i for i, w in enumerate(listed[: lm.MEMBERS])}
    other = lambda w: int.from_bytes(w[:3], "big") % lm.OTHERS
    mass = Counter()
    for w in count:
        if w not in rank:
            mass[other(w)] += count[w] + 0.5
    bend = lambda x: x / (1 + np.abs(x))
    sigmoid = lambda x: 0.5 + 0.5 * bend(x)
    softmax = lambda x: x - np.logaddexp.reduce(x)
    size, hidden = lm.MEMBERS // lm.GROUPS, 32
    kinds = Counter()

    def plain(text):
        state, before, total = np.zeros(hidden), lm.MEMBERS + lm.OTHERS, 0.0
        for t in tokens(text):
            x = params["look"][before]
            both = sigmoid(x[: 2 * hidden] + state @ params["gates"])
            new = bend(x[2 * hidden :] + (both[hidden:] * state) @ params["fresh"])
            state = state + both[:hidden] * (new - state)
            classes = softmax(state @ params["classes"] + params["class_odds"])
            if t is None:
                total += classes[lm.GROUPS + lm.OTHERS]
            elif t in rank:
                before, g, m = rank[t], rank[t] // size, rank[t] % size
                within = softmax(params["members"][g] @ state + params["member_odds"][g])
                total += classes[g] + within[m]
            else:
                before = lm.MEMBERS + other(t)
                if t in count:
                    total += classes[lm.GROUPS + other(t)] + math.log((count[t] + 0.5) / mass[other(t)])
                else:
                    total += classes[-1]
            kinds[t is None, t in rank, t in count, t in vocabulary.rank] += 1
        return total / math.log(10)

    for i, text in data[80:]:
        assert found[i].score == pytest.approx(plain(text), rel=1e-4), i
    assert len(kinds) == 5 and ends == 100
