"""A quality classifier on graded ratings: ordinal regression with cumulative logistic links.

One weight per hashed text feature serves all grades; ordered thresholds cut the score into grades:
``P(grade <= j) = sigmoid(threshold_j - score)``. It is fitted on a bounded sample of the rated
rows, in one task, and then scores every document where it lies.
"""

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.rows import keyed
from usagelens.storage import store

BUCKETS = 1 << 15
_REMEMBERED = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"(.)\1+")


def _shape(word: str) -> str:
    """A word's pattern: runs of letters by case, digits as 0, marks as they are, runs once."""

    def letters(found: re.Match) -> str:
        part = found[0]
        return "A" if part.isupper() else "Aa" if part[0].isupper() else "a"

    return _RUNS.sub(r"\1", re.sub(r"\d+", "0", _LETTERS.sub(letters, word)))


class Features:
    """Feature numbers of texts: words, their shapes, and words that repeat the one before."""

    def __init__(self, buckets: int = BUCKETS):
        self._buckets = buckets
        self._known: dict[bytes, tuple[int, int, int]] = {}

    def _look(self, word: bytes) -> tuple[int, int, int]:
        text = word.decode("utf-8", "replace")
        names = (f"w {text.lower()}", f"s {_shape(text)}", f"again {len(text) > 3}")
        return tuple(xxhash.xxh64_intdigest(n) % self._buckets for n in names)

    def __call__(self, text: bytes) -> np.ndarray:
        known, words = self._known, text.split()
        if len(known) > _REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self._look(word)
        found = np.array([known[w] for w in words], np.int32).reshape(-1, 3)
        again = [i for i in range(1, len(words)) if words[i] == words[i - 1]]
        return np.concatenate([found[:, :2].ravel(), found[again, 2]])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(
    ids: np.ndarray,
    bounds: np.ndarray,
    grades: np.ndarray,
    n_grades: int,
    buckets: int = BUCKETS,
    steps: int = 150,
    rate: float = 0.3,
    decay: float = 1e-4,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of least loss, by full steps with adaptive rates.

    Text ``i`` has the features ``ids[bounds[i]:bounds[i + 1]]``, each with one over their number.
    Thresholds are the first one and the logarithms of the gaps, so they stay in order.
    """
    sizes = np.maximum(np.diff(bounds), 1)
    owner = np.repeat(np.arange(len(grades)), np.diff(bounds))
    share = (1 / sizes)[owner]
    upto = np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(len(grades), 1)
    start = np.log((upto + 0.01) / (1.01 - upto))
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    params = np.concatenate([np.zeros(buckets), start[:1], gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w = params[:buckets]
        gaps = np.exp(params[buckets + 1 :])
        cuts = np.concatenate([[-np.inf], params[buckets] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(owner, w[ids] * share, len(grades))
        high, low = _sigmoid(cuts[grades + 1] - score), _sigmoid(cuts[grades] - score)
        high[grades == n_grades - 1], low[grades == 0] = 1, 0
        chance = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        d_score = (d_high - d_low) / len(grades)
        gradient = np.empty_like(params)
        gradient[:buckets] = np.bincount(ids, (d_score[owner] * share), buckets) + decay * w
        d_cut = np.bincount(grades, d_low, n_grades)[1:] - np.bincount(grades, d_high, n_grades)[:-1]
        d_cut = d_cut / len(grades)
        gradient[buckets] = d_cut.sum()
        gradient[buckets + 1 :] = np.cumsum(d_cut[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        params = params - rate * move
    gaps = np.exp(params[buckets + 1 :])
    return params[:buckets], params[buckets] + np.concatenate([[0], np.cumsum(gaps)])


def grade_documents(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    n_grades: int = 3,
    tail_from: int = 1,
    sample_rows: int = 8192,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``id, expected_grade, tail_probability``, one row per row of ``docs``.

    ``ratings`` holds ids with a grade from 0 to ``n_grades - 1``; of an id rated more than once
    the lowest counts. At most ``sample_rows`` ids, those of least hash, are learned from.
    ``tail_probability`` is that of grade ``tail_from`` or more. Without any rating all grades are
    equally likely. A null text counts as empty and gets the scores of a text without features.
    """
    usable = ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    usable = usable.dropna().filter(F.col("grade").between(0, n_grades - 1))
    order = F.xxhash64(F.lit("quality"), "id")
    sample = usable.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(order, "id")
    sample = store(sample.limit(sample_rows), "rated-sample")
    rows = keyed(docs, id_col, text_col).select("id", "text")

    def list_features(batches):
        features = Features(buckets)
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            found = [features(t.as_py() or b"").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["grade"], pa.array(found, pa.binary())], ["grade", "features"]
            )

    def learn(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(x.as_py(), np.int32) for x in table["features"]]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        grades = table["grade"].to_numpy().astype(np.int64)
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        weights, cuts = fit(ids, bounds, grades, n_grades, buckets)
        return pa.table({"weights": [weights.tobytes()], "cuts": [cuts.tobytes()]})

    learned = rows.join(F.broadcast(sample), "id").select("text", "grade")
    listed = learned.mapInArrow(list_features, "grade int, features binary")
    model = (
        listed.withColumn("model", F.lit(1)).groupBy("model").applyInArrow(learn, "weights binary, cuts binary").collect()
    )  # the sample bounds this one task, the buckets what it returns
    if model:
        weights = np.frombuffer(model[0]["weights"]).astype(np.float32)
        cuts = np.frombuffer(model[0]["cuts"])
    else:
        weights = np.zeros(buckets, np.float32)
        cuts = np.array([math.log(j / (n_grades - j)) for j in range(1, n_grades)])
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches):
        features = Features(buckets)
        for batch in batches:
            scores = []
            for text in batch["text"].cast(pa.large_binary()):
                ids = features(text.as_py() or b"")
                scores.append(float(shared.value[ids].mean()) if len(ids) else 0.0)
            above = _sigmoid(np.array(scores)[:, None] - cuts[None, :])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(above.sum(1)), pa.array(above[:, tail_from - 1])],
                ["id", "expected_grade", "tail_probability"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, expected_grade double, tail_probability double")
