import random

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm.toxicity import FEATURES, Measurer, labelled_sample, lexicon, plain, toxicity, units


def test_plain_words():
    assert plain("Idiot!!") == ("idiot", False)
    assert plain("1d10t") == ("idiot", True)
    assert plain("s.t-u.p*id,") == ("stupid", True)
    assert plain("2024") == ("2024", False) and plain("...") == ("", False)
    assert units("abcdefgh") == ["abcdefgh", "abc-", "abcd-", "abcde-", "abcdef-", "abcdefg-"]


def test_features():
    measure = Measurer({"fool": 3.0, "scou-": 2.0})
    found = dict(zip(FEATURES, measure(b"YOU f0ol! and other words here scoundrel there?"), strict=True))
    assert found["hit_share"] == 2 / 8 and found["best_score"] == 3 and found["distinct_hits"] == 2
    assert found["disguised_hit_share"] == 1 / 8 and found["near_second_person"] == 1 / 8
    assert found["second_person_share"] == 1 / 8 and found["capital_words"] == 1 / 8
    assert found["exclamations"] == 1 / 8 and found["questions"] == 1 / 8
    assert measure(b"") == measure(b" \n") == [0.0] * len(FEATURES)
    again = dict(zip(FEATURES, measure(b"new words then fool"), strict=True))
    assert again["hit_share"] == 1 / 4


def corpus(n=600):
    pick = random.Random(7)
    common = [f"{a}{b}x" for a in "bdfgklmn" for b in ("ar", "el", "or", "ip", "um")]
    insults = ["gritmouth", "blorkhead", "snarfer"]
    data, labels = [], []
    for i in range(n):
        text = pick.choices(common, k=pick.randint(20, 60))
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                text.insert(pick.randrange(len(text)), pick.choice(insults))
        data.append((i, " ".join(text)))
        labels.append((i, toxic))
    return data, labels


def test_held_out_documents(spark, documents):
    data, labels = corpus()
    known = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, toxic int")
    found = toxicity(documents(data), known, sample_rows=400, trees=5, depth=2)
    held = {r.id: r for r in found.collect() if r.id % 4 == 0}
    wrong = [i for i, toxic in labels if i in held and held[i].predicted != toxic]
    assert len(wrong) <= 2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held.values())


def test_lexicon_lists_what_tells(spark):
    data, labels = corpus()
    toxic = dict(labels)
    sample = spark.createDataFrame([(t, toxic[i]) for i, t in data], "text string, toxic int")
    found = lexicon(sample)
    assert {"gritmouth", "blorkhead", "snarfer", "gri-"} <= found.keys()
    assert not any(u.startswith("bar") for u in found)


def test_sample_is_bounded_and_parted(spark):
    labels = spark.createDataFrame([(i % 900, i % 2) for i in range(1000)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    found = labelled_sample(labels, 500)
    assert found.count() == 500 == found.select("id").distinct().count()
    assert {r.part for r in found.collect()} == {0, 1, 2}
    assert rows(labelled_sample(labels, 500)) == rows(found)


def test_messy_rows_and_missing_labels(spark, documents):
    data, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(MESSY + [(i + 100, t) for i, t in data])
    shifted = known.selectExpr("doc_id + 100 as doc_id", "toxic")
    found = toxicity(docs, shifted, trees=2, depth=2)
    assert found.count() == len(MESSY) + len(data) and found.filter("score is null").count() == 0
    for labels in (known.limit(0), shifted.filter("toxic = 1")):
        found = toxicity(documents(MESSY), labels)
        assert {(r.score, r.predicted) for r in found.collect()} == {(0.0, 0)}
    assert toxicity(documents(MESSY).limit(0), known).count() == 0


def test_labels_outside_0_and_1_do_not_count(spark, documents):
    data, labels = corpus(300)
    kinds = "doc_id long, toxic int"
    good = spark.createDataFrame([x for x in labels if x[0] % 3], kinds)
    odd = spark.createDataFrame([(i, v) for i, _ in labels[::3] for v in (2, -1, 7)] + [(3, None)], kinds)
    plain_scores = rows(toxicity(documents(data), good, trees=2, depth=2))
    assert rows(toxicity(documents(data), good.unionByName(odd), trees=2, depth=2)) == plain_scores
    as_text = good.unionByName(odd).selectExpr("doc_id", "cast(toxic as string) as toxic")
    as_text = as_text.unionByName(spark.createDataFrame([(6, "bad")], "doc_id long, toxic string"))
    assert rows(toxicity(documents(data), as_text, trees=2, depth=2)) == plain_scores
    assert toxicity(documents(data), odd).filter("score <> 0").count() == 0


def plain_features(text, lexicon):
    """The features of a text, word by word, from their descriptions."""
    import math

    from usagelens.llm.toxicity import DISGUISE, NEAR, SECOND_PERSON

    out = dict.fromkeys(FEATURES, 0.0)
    found = [w.decode() for w in (text or "").encode().split()]
    if not found:
        return [0.0] * len(FEATURES)
    scores, persons, hit_words, disguised_hits = [], [], set(), 0
    for word in found:
        low = word.lower()
        core, disguised = low, False
        if not low.isalpha():
            core = low
            while core and not core[0].isalnum():
                core = core[1:]
            while core and not core[-1].isalnum():
                core = core[:-1]
            if any(c.isalpha() for c in core) and not core.isalpha():
                core, disguised = "".join(c for c in core.translate(DISGUISE) if c.isalnum()), True
        names = [core] + [core[:n] + "-" for n in range(3, 8) if len(core) > n]
        score = max([lexicon.get(n, 0.0) for n in names]) if core else 0.0
        scores.append(score)
        persons.append(core in SECOND_PERSON)
        if score > 0:
            hit_words.add(word)
            disguised_hits += disguised
        upper = sum(c.isupper() for c in word)
        out["capital_share"] += upper
        out["capital_words"] += upper > 1 and upper == sum(c.isalpha() for c in word)
        out["exclamations"] += word.count("!")
        out["questions"] += word.count("?")
        out["other_marks"] += sum(not c.isalnum() and c not in "!?" for c in word)
        out["disguised_share"] += disguised
    n = len(found)
    hits = [i for i, s in enumerate(scores) if s > 0]
    near = sum(any(persons[max(i - NEAR, 0) : i + NEAR + 1]) for i in hits)
    for name in ("capital_words", "exclamations", "questions", "other_marks", "disguised_share"):
        out[name] /= n
    out["capital_share"] /= len(text.encode())
    return list(
        (
            out
            | {
                "hit_share": len(hits) / n,
                "log_hits": math.log1p(len(hits)),
                "score_share": sum(scores) / n,
                "best_score": max(scores),
                "distinct_hits": len(hit_words),
                "disguised_hit_share": disguised_hits / n,
                "near_second_person": near / n,
                "second_person_share": sum(persons) / n,
                "log_words": math.log1p(n),
            }
        ).values()
    )


def test_scores_equal_plain_ones(spark, monkeypatch):
    """All texts of a small table: features, trees and calibrated steps walked in Python."""
    import bisect
    import math

    import pytest

    from usagelens.llm import toxicity as tx

    seen = {}

    def keeping(name, made):
        def build(*args, **kwargs):
            estimator = made(*args, **kwargs)
            fit = estimator.fit
            estimator.fit = lambda table: seen.setdefault(name, fit(table))
            return estimator

        return build

    monkeypatch.setattr(tx, "GBTClassifier", keeping("trees", tx.GBTClassifier))
    monkeypatch.setattr(tx, "IsotonicRegression", keeping("steps", tx.IsotonicRegression))
    listed = tx.lexicon
    monkeypatch.setattr(tx, "lexicon", lambda sample: seen.setdefault("words", listed(sample)))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = {r.id: r for r in tx.toxicity(docs, labels, trees=5, depth=3).collect()}

    def leaf(node, features):
        while node.subtreeDepth():
            split = node.split()
            goes = features[split.featureIndex()] <= split.threshold()
            node = node.leftChild() if goes else node.rightChild()
        return node.prediction()

    roots = [t._java_obj.rootNode() for t in seen["trees"].trees]
    edges, values = (list(v.toArray()) for v in (seen["steps"].boundaries, seen["steps"].predictions))

    def step(x):
        i = bisect.bisect_left(edges, x)
        if i < len(edges) and edges[i] == x:
            return values[i]
        if i in (0, len(edges)):
            return values[min(i, len(edges) - 1)]
        return values[i - 1] + (values[i] - values[i - 1]) * (x - edges[i - 1]) / (edges[i] - edges[i - 1])

    for r in docs.select("doc_id", "text").collect():
        features = plain_features(r.text, seen["words"])
        margin = sum(w * leaf(t, features) for w, t in zip(seen["trees"].treeWeights, roots, strict=True))
        chance = 1 / (1 + math.exp(-2 * margin))
        score = 0.999 * step(chance) + 0.001 * chance
        assert found[r.doc_id].score == pytest.approx(score, abs=1e-6), r.doc_id
        assert found[r.doc_id].predicted == (score >= 0.5)
    assert len(found) == 1000 and len({r.score for r in found.values()}) > 5
