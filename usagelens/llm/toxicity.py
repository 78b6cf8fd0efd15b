"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon, the trees and the calibration are fitted on separate parts of a sample of the labelled
rows; every document is then measured and scored. Labels, language, source and id never enter a
feature.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.rows import keyed
from usagelens.storage import store

# Pronouns of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros su sus".split()
)
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
FEATURES = (
    "hit_share",
    "log_hits",
    "score_share",
    "best_score",
    "distinct_hits",
    "disguised_hit_share",
    "near_second_person",
    "second_person_share",
    "capital_share",
    "capital_words",
    "exclamations",
    "questions",
    "other_marks",
    "disguised_share",
    "log_words",
)
PREFIXES = range(3, 8)
NEAR = 4
_REMEMBERED = 300_000


def plain(word: str) -> tuple[str, bool]:
    """A word in small letters without marks, and whether marks or digits within disguised it."""
    low = word.lower()
    if low.isalpha():
        return low, False
    first = next((i for i, c in enumerate(low) if c.isalnum()), len(low))
    last = next((i for i in range(len(low), first, -1) if low[i - 1].isalnum()), first)
    core = low[first:last]
    if core.isalpha() or not any(c.isalpha() for c in core):
        return core, False
    return "".join(c for c in core.translate(DISGUISE) if c.isalnum()), True


def units(word: str) -> list[str]:
    """What the lexicon lists: whole words, and stems of 3 to 7 letters that words begin with."""
    return [word, *[f"{word[:n]}-" for n in PREFIXES if len(word) > n]]


class Measurer:
    """Dense features of texts under a lexicon, remembering those of words."""

    def __init__(self, lexicon: dict[str, float]):
        self._lexicon = lexicon
        self._heads = {unit.rstrip("-")[: PREFIXES[0]] for unit in lexicon}
        self._known: dict[bytes, int] = {}
        self._table = np.zeros((1 << 16, 9))

    def _score(self, core: str) -> float:
        if core[: PREFIXES[0]] not in self._heads:
            return 0.0
        return max(self._lexicon.get(u, 0.0) for u in units(core))

    def _look(self, word: str) -> tuple[float, ...]:
        if word.isalpha() and word.islower():
            return (self._score(word), 0, word in SECOND_PERSON, 0, 0, 0, 0, 0, 0)
        core, disguised = plain(word)
        score = self._score(core) if core else 0.0
        marks = 0 if word.isalnum() else sum(not c.isalnum() for c in word)
        upper = sum(c.isupper() for c in word)
        shouts, asks = word.count("!"), word.count("?")
        return (
            score,
            score > 0 and disguised,
            core in SECOND_PERSON,
            upper,
            upper > 1 and upper == sum(c.isalpha() for c in word),
            shouts,
            asks,
            marks - shouts - asks,
            disguised,
        )

    def __call__(self, text: bytes) -> list[float]:
        words = text.split()
        if not words:
            return [0.0] * len(FEATURES)
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            at = known[word] = len(known)
            if at == len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._table[at] = self._look(word.decode("utf-8", "replace"))
        ids = np.array([known[w] for w in words], np.int64)
        seen = self._table[ids]
        score, person = seen[:, 0], seen[:, 2] > 0
        hits = score > 0
        upto = np.concatenate([[0], np.cumsum(person)])
        at = np.flatnonzero(hits)
        near = upto[np.minimum(at + NEAR + 1, len(words))] - upto[np.maximum(at - NEAR, 0)]
        n, total = len(words), seen.sum(0)
        return [
            hits.sum() / n,
            math.log1p(hits.sum()),
            score.sum() / n,
            float(score.max()),
            float(len(np.unique(ids[at]))),
            total[1] / n,
            float((near > 0).sum()) / n,
            total[2] / n,
            total[3] / len(text),
            total[4] / n,
            total[5] / n,
            total[6] / n,
            total[7] / n,
            total[8] / n,
            math.log1p(n),
        ]


def _texts(batch: pa.RecordBatch):
    for value in batch["text"].cast(pa.large_binary()):
        yield value.as_py() or b""


def lexicon(
    sample: DataFrame, min_docs: int = 3, min_log_odds: float = 2.0, most: int = 5000
) -> dict[str, float]:
    """Words and stems by how much likelier toxic texts hold them, from ``text, toxic`` rows.

    Kept are those in ``min_docs`` toxic texts or more with log odds of ``min_log_odds`` or more,
    the ``most`` most telling ones.
    """

    def count(batches):
        for batch in batches:
            held = (Counter(), Counter())
            for text, toxic in zip(_texts(batch), batch["toxic"].to_pylist(), strict=True):
                words = {plain(w.decode("utf-8", "replace"))[0] for w in text.split()}
                held[toxic].update({u for w in words if w for u in units(w)})
            every = list(held[0].keys() | held[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(every, pa.string()),
                    pa.array([held[1][u] for u in every], pa.int64()),
                    pa.array([held[0][u] for u in every], pa.int64()),
                ],
                ["unit", "toxic", "clean"],
            )

    totals = sample.groupBy("toxic").count().collect()
    docs = {r["toxic"]: r["count"] for r in totals}
    counted = sample.select("text", "toxic").mapInArrow(
        count, "unit string, toxic long, clean long"
    )
    summed = counted.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (docs.get(1, 0) - F.col("t") + 0.5)) - F.log(
        (F.col("c") + 0.5) / (docs.get(0, 0) - F.col("c") + 0.5)
    )
    telling = summed.filter(F.col("t") >= min_docs).withColumn("odds", odds)
    rows = telling.filter(F.col("odds") >= min_log_odds).orderBy(F.desc("odds"), "unit").limit(most)
    return {r["unit"]: r["odds"] for r in rows.collect()}


def labelled_sample(labels: DataFrame, most: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """``id, toxic, part`` of at most ``most`` labelled ids, those of least hash. ``part`` is 0 for
    the lexicon, 1 for the trees and 2 for the calibration, in the ratio 2 : 2 : 1. Labels other than
    0 and 1 do not count, and an id with both is toxic."""
    usable = labels.select(F.col(id_col).alias("id"), F.col("toxic").try_cast("int").alias("toxic"))
    usable = usable.dropna().filter(F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit("toxicity"), "id")
    fold = F.pmod(order, F.lit(5))
    part = F.when(fold < 2, 0).when(fold < 4, 1).otherwise(2)
    return usable.withColumn("part", part).orderBy(order, "id").limit(most)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 20_000,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """``id, score, predicted``, one row per row of ``docs``, learning from all of ``labels`` given.

    The sample, at most ``sample_rows`` ids with a label, is small enough to be broadcast. Without
    both labels in its parts all documents get its share of toxic rows, 0 without any row. A null
    text counts as empty; texts are read whole whatever their length, one at a time; equal texts
    have equal scores, repeated rows each a row; columns but id and text are ignored.
    """
    rows = keyed(docs, id_col, text_col).select("id", "text")
    sample = store(labelled_sample(labels, sample_rows, id_col), "labelled-sample")
    learned = store(rows.join(F.broadcast(sample), "id"), "labelled-texts")
    words = lexicon(learned.filter("part = 0"))

    def measure(batches):
        measurer = Measurer(words)
        for batch in batches:
            values = [measurer(t) for t in _texts(batch)]
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in others], pa.array(values, pa.list_(pa.float64()))],
                [*others, "features"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    known = learned.select("text", "toxic", "part").mapInArrow(
        measure, "toxic int, part int, features array<double>"
    )
    known = known.withColumn("features", array_to_vector("features"))
    known = store(known.withColumn("toxic", F.col("toxic").cast("double")), "labelled-features")
    counts = {(r["part"], r["toxic"]): r["count"] for r in known.groupBy("part", "toxic").count().collect()}
    if not all(counts.get((part, label)) for part in (1, 2) for label in (0.0, 1.0)):
        total = sum(counts.values())
        share = sum(n for (_, t), n in counts.items() if t) / total if total else 0.0
        return rows.select(
            "id", F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted")
        )
    boosted = GBTClassifier(
        featuresCol="features", labelCol="toxic", maxIter=trees, maxDepth=depth, seed=7
    ).fit(known.filter("part = 1"))
    chance = vector_to_array("probability")[1]
    held = boosted.transform(known.filter("part = 2")).select("toxic", chance.alias("chance"))
    calibrated = IsotonicRegression(featuresCol="chance", labelCol="toxic").fit(held)

    measured = rows.mapInArrow(measure, f"id {kind}, features array<double>")
    measured = measured.withColumn("features", array_to_vector("features"))
    scored = boosted.transform(measured).select("id", chance.alias("chance"))
    scored = calibrated.transform(scored)
    # The calibrated steps decide; within a step the trees' own order is kept.
    score = F.col("prediction") * 0.999 + F.col("chance") * 0.001
    return scored.select(
        "id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
