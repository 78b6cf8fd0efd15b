import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import MESSY
from usagelens.llm.quality_rules import cutoffs, drop_low_quality, judge, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    found = WORD.findall(text)
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    count, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(found), len("".join(found)), symbols, len(lines) - len(set(lines)), len(covered))


def counts(frame):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows(frame.select("doc_id", *[f"_quality_m.{n}" for n in names]))


def test_counts_equal_plain_ones(documents):
    pick = random.Random(2)
    pieces = ["a", "b", "c d", "a b c d e", "\n", "#x", "é*", "\t", "  ", "|"]
    data = [(i, "".join(pick.choices(pieces + [" "] * 5, k=pick.randint(0, 60)))) for i in range(200)]
    data += [row for row in MESSY if row[0] != 11]
    expect = sorted(((i, *plain(t)) for i, t in data), key=repr)
    assert counts(measure(documents(data))) == expect
    assert any(row[-1] for row in expect)


def corpus(n=400):
    """Prose of common words; every tenth text is full of marks, by source more or less."""
    pick = random.Random(1)
    names = [pick.choice("bcdfglmnrst") + pick.choice("aeiou") * 2 + "x" for _ in range(300)]
    data = []
    for i in range(n):
        text = " ".join(pick.choices(names, k=pick.randint(30, 80)))
        source = "marked" if i % 4 == 0 else "plain"
        if source == "marked":
            text = re.sub("x", "x|" if pick.random() < 0.9 else "x", text)
        if i % 10 == 7:
            text = text.replace(" ", "### ")
        data.append((i, text, source))
    return data


def test_cutoffs_follow_the_source(documents):
    """Marks that are usual in one source are no fault there, and are elsewhere."""
    data = corpus() + [(1000, corpus(1)[0][1].replace("x", "x|"), "plain")]
    judged = judge(documents(data), min_rows=50)
    kept = {r.doc_id: r._quality_kept for r in judged.collect()}
    assert not kept[1000] and not any(kept[i] for i in range(7, 400, 10) if i % 4)
    assert all(kept[i] for i in range(400) if i % 10 != 7)
    stay = drop_low_quality(documents(data), min_rows=50)
    assert stay.columns == documents(data).columns
    assert {r.doc_id for r in stay.collect()} == {i for i, k in kept.items() if k}


def test_small_groups_take_wider_cutoffs(documents):
    data = corpus() + [(2000, corpus(1)[0][1], "lone")]
    frame = measure(documents(data).withColumns({"_quality_g0": F.lit("en"), "_quality_g1": F.col("source")}))
    found = {r.g1: r for r in cutoffs(frame, min_rows=50).collect()}
    assert found["marked"].symbol_share_high > found["plain"].symbol_share_high
    whole = cutoffs(frame.withColumn("_quality_g1", F.lit("all")), min_rows=50).first()
    assert abs(found["lone"].symbol_share_high - whole.symbol_share_high) < 0.05


def test_messy_and_empty_tables(documents):
    judged = judge(documents(MESSY))
    failed = {r.doc_id for r in judged.filter("_quality_base_failed").collect()}
    assert failed == {1, 2, 3, None, 5, 6, 8, 9, 11}
    assert judge(documents(MESSY).limit(0)).count() == 0
    text = " ".join(f"word{i}" for i in range(40))
    assert drop_low_quality(documents([(None, text, None), (2, text, None)])).count() == 2


def test_columns_with_the_names_of_its_own(documents):
    docs = documents(corpus(60))
    names = {"k": "_quality_m", "x": "_quality_kept", "row": "own_quality_m", "id": "_quality_g0", "kept": "_quality_text"}
    clashing = docs.withColumnsRenamed(names)
    stay = drop_low_quality(clashing, min_rows=20)
    assert stay.columns == clashing.columns
    assert rows(stay) == rows(drop_low_quality(docs, min_rows=20))
    judged = judge(clashing, carry=["doc_id"], min_rows=20).select("doc_id", "_quality_kept", "_quality_m.n_words")
    assert rows(judged) == rows(judge(docs, carry=["doc_id"], min_rows=20).select("doc_id", "_quality_kept", "_quality_m.n_words"))


def exact_band(values, q, error):
    """The least and greatest value whose rank is within ``error`` of the quantile."""
    values = sorted(values)
    n = len(values)
    low = values[max(0, min(n - 1, int((q - error) * n) - 1))]
    return low, values[max(0, min(n - 1, int((q + error) * n) + 1))]


def test_verdicts_equal_those_of_exact_quantiles(documents):
    """Where a measure is not near its cutoff, as far as the sketches' ranks may err."""
    from usagelens.llm import quality_rules as qr

    data = corpus(900)
    judged = judge(documents(data), min_rows=50)
    found = judged.select("doc_id", "source", "_quality_m.*", "_quality_base_failed", "_quality_kept").collect()
    usable = [r for r in found if not r._quality_base_failed]
    error, sure = 0.02, 0
    for source in ("marked", "plain"):
        own = [r for r in usable if r.source == source]
        limits = {}
        for name, least in {"mean_word": qr.WORD_CHARS_SPREAD, **qr.SHARES}.items():
            (q1a, q1b), (q3a, q3b) = (exact_band([r[name] for r in own], q, error) for q in (0.25, 0.75))
            wide, narrow = max(q3b - q1a, least), max(q3a - q1b, least)
            limits[name] = (q1a - 3 * wide, q1b - 3 * narrow, q3a + 3 * narrow, q3b + 3 * wide)
        for r in own:
            verdicts = []
            for name, (low_a, low_b, high_a, high_b) in limits.items():
                if name == "mean_word":
                    noise = qr.WORD_CHARS_NOISE / max(r.n_words, 1) ** 0.5
                else:
                    size, factor = qr.NOISE[name]
                    noise, low_a, low_b = factor / max(r[size], 1) ** 0.5, -1e9, -1e9
                if r[name] > high_b + noise or r[name] < low_a - noise:
                    verdicts.append(False)
                elif low_b - noise <= r[name] <= high_a + noise:
                    verdicts.append(True)
                else:
                    verdicts.append(None)
            if False in verdicts or None not in verdicts:
                assert r._quality_kept == (False not in verdicts), r
                sure += 1
    assert sure > 0.95 * len(usable) and any(not r._quality_kept for r in usable)
    assert not any(r._quality_kept for r in found if r._quality_base_failed)
