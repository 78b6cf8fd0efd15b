"""Scoring documents by a recurrent language model that is trained where the documents lie.

Words are counted over all training documents. The most frequent are members of classes of the
model; any other word belongs to a class by the bytes it begins with, within which it has its
share of the counts, and a word never seen to the class of the unknown. So probabilities over all
words sum to one, however many there are.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import recurrent
from usagelens.llm.rows import keyed
from usagelens.llm.words import pieces, utf8
from usagelens.storage import store

HEAD = 1 << 17
MEMBERS = 4096
GROUPS = 64
OTHERS = 31
_PREFIX = 3
_SHARES = 1 << 20
_BLOCK = 1 << 14
_END = 1 << 30
_TOKENS = 1 << 21
_COUNTS = 1 << 20


def _pieces(batches, names: list[str] = ()):
    """Texts of a few megabytes, nulls as empty, and columns ``names`` of their rows."""
    for batch in batches:
        for first, last in pieces(utf8(batch["text"])[1]):
            texts, *rest = (batch[n].slice(first, last - first) for n in ["text", *names])
            yield texts.fill_null(""), rest


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts one after another, with A to Z as lower case, and how many each text has."""
    listed = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = listed.flatten()
    real = np.asarray(pc.not_equal(pc.binary_length(words), 0))
    before = np.concatenate([[0], np.cumsum(real)])
    count = np.diff(before[np.asarray(listed.offsets) - listed.offsets[0].as_py()])
    return words.filter(pa.array(real)).cast(pa.binary()), count


def count_words(texts: DataFrame) -> DataFrame:
    """``word, n``: how often each word occurs in ``text``, with A to Z as lower case.

    Only one row per distinct word leaves some pieces of text, as many as have ``_COUNTS`` rows.
    """

    def added(parts):
        sums = pa.table(list(map(pa.chunked_array, zip(*parts))), ["word", "n"])
        sums = sums.group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns({"n_sum": "n"}).to_batches()

    def run(batches):
        parts, size = [], 0
        for piece, _ in _pieces(batches):
            counts = pc.value_counts(_words(piece)[0])
            parts.append(counts.flatten())
            size += len(counts)
            if size > _COUNTS:
                yield from added(parts)
                parts, size = [], 0
        if size:
            yield from added(parts)

    counted = texts.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Codes of words: the rank of those among the head, else a negative number for the class.

    As inputs of the model they are numbered: members first, then the classes of others by their
    first bytes, then the end.
    """

    def __init__(self, head: list[tuple[bytes, int]]):
        self.words = pa.array([w for w, _ in head], pa.binary())
        self.counts = np.array([n for _, n in head], np.int64)
        self.end = MEMBERS + OTHERS
        self.others = self._others(self.words)

    @property
    def rank(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    @staticmethod
    def other(word: bytes) -> int:
        return int.from_bytes(word[:_PREFIX]) % OTHERS

    @staticmethod
    def _others(words: pa.Array) -> np.ndarray:
        """The class of each word, as ``other`` tells it."""
        data, offsets = utf8(words)
        out = np.zeros(len(words), np.int32)
        for k in range(_PREFIX):
            at = np.flatnonzero(np.diff(offsets) > k)
            out[at] = out[at] * 256 + data[offsets[at] + k]
        return out % OTHERS

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Codes of the words of texts, each followed by its end, how many each text has, and the
        words outside the head."""
        words, count = _words(texts)
        found = np.array(pc.index_in(words, value_set=self.words).fill_null(-1))
        absent = np.flatnonzero(found < 0)
        rare = words.take(pa.array(absent))
        found[absent] = -1 - self._others(rare)
        ends = np.cumsum(count + 1) - 1
        inside = np.ones(len(found) + len(count), bool)
        inside[ends] = False
        out = np.full(len(inside), _END, np.int32)
        out[inside] = found
        return out, count + 1, rare

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Codes as numbers of inputs."""
        out = np.where(codes < 0, MEMBERS - 1 - codes, codes)
        apart = np.flatnonzero((codes >= MEMBERS) & (codes != _END))
        out[apart] = MEMBERS + self.others[codes[apart]]
        out[codes == _END] = self.end
        return out


def _kinds(ids: np.ndarray) -> np.ndarray:
    """The class of each number: groups of members, then others, then the end."""
    size = MEMBERS // GROUPS
    return np.where(ids < MEMBERS, ids // size, ids - MEMBERS + GROUPS)


def _train(model, vocabulary, unknown: float, lanes: int, window: int, rate: float):
    """A task's part of a round: the parameters after its texts, in blocks, and its tokens.

    A piece of text is one stream, cut into ``lanes`` that begin with a state of 0. Of words outside
    the head a share of ``unknown`` counts as never seen.
    """

    def run(batches):
        params = {k: v.copy() for k, v in model.value.items()}
        adam, words = recurrent.Adam(params, rate), vocabulary.value
        unknown_kind = len(params["class_odds"]) - 1
        draw = np.random.default_rng(11)
        tokens = 0
        for texts, _ in _pieces(batches):
            codes, _, _ = words.codes(texts)
            unseen = (codes < 0) & (draw.random(len(codes), np.float32) < unknown)
            stream = words.numbers(codes)
            own = min(lanes, max(1, len(stream) // window))
            steps = -(-len(stream) // own)
            pad = steps * own - len(stream)
            stream = np.append(stream, stream[:1].repeat(pad)).reshape(own, steps).T
            unseen = np.append(unseen, np.zeros(pad, bool)).reshape(own, steps).T
            inputs = np.vstack([np.full((1, own), words.end), stream[:-1]])
            state = np.zeros((own, params["fresh"].shape[0]), np.float32)
            for t in range(0, steps, window):
                part = slice(t, t + window)
                target, now = stream[part], inputs[part]
                kinds = np.where(unseen[part], unknown_kind, _kinds(target))
                member = np.where(target < MEMBERS, target, -1)
                gradient, state, _ = recurrent.gradients(
                    params, now, now == words.end, state, kinds, member
                )
                adam.step(params, gradient)
            tokens += steps * own
        if tokens:
            vector = recurrent.to_vector(params)
            cuts = range(0, len(vector), _BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c // _BLOCK for c in cuts], pa.int32()),
                    pa.array([TaskContext.get().partitionId() % 256] * len(cuts), pa.int32()),
                    pa.array([float(tokens)] * len(cuts)),
                    pa.array([vector[c : c + _BLOCK].tobytes() for c in cuts], pa.binary()),
                ],
                ["block", "salt", "weight", "part"],
            )

    return run


def _mean(table: pa.Table) -> pa.Table:
    weights = table["weight"].to_numpy()
    parts = np.stack([np.frombuffer(x.as_py(), np.float32) for x in table["part"]])
    mean = (weights[:, None] / weights.sum() * parts).sum(0).astype(np.float32)
    return pa.table(
        {
            "block": pa.array([table["block"][0].as_py()], pa.int32()),
            "weight": [float(weights.sum())],
            "part": pa.array([mean.tobytes()], pa.binary()),
        }
    )


def _deal(lengths: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts dealt to lanes, the longest first, each to the lane with least so far: for each its
    lane and its place there, and the lanes' lengths, the longest lane first."""
    heap = [(0, lane) for lane in range(lanes)]
    lane_of, place = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        at, lane = heapq.heappop(heap)
        lane_of[i], place[i] = lane, at
        heapq.heappush(heap, (at + sizes[i], lane))
    heap.sort(reverse=True)
    number = np.empty(lanes, np.int64)
    number[[lane for _, lane in heap]] = np.arange(lanes)
    return number[lane_of], place, np.array([size for size, _ in heap])


def _logs(params: recurrent.Params, stream: np.ndarray, lengths: np.ndarray, end: int):
    """For each token of texts one after another, numbered as inputs, the logs of its probability,
    up to that of the word within its class, and of the unknown's, each text from its own start.

    The longest lanes come first, so those with tokens left are always the first ones, and a few
    long texts do not hold the others to as few lanes.
    """
    lane, place, sizes = _deal(lengths, int(max(1, min(1024, len(lengths), lengths.sum() // 256))))
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts[lane] + place - np.cumsum(lengths) + lengths, lengths) + np.arange(len(stream))
    dealt = np.empty_like(stream)
    dealt[at] = stream
    own, unknown = (np.empty(len(stream), np.float32) for _ in range(2))
    state = np.zeros((len(sizes), params["fresh"].shape[0]), np.float32)
    last = np.full((1, len(sizes)), end, stream.dtype)
    t, held = 0, []
    while t < sizes[0]:
        lanes = int(np.searchsorted(-sizes, -t))
        step = np.arange(t, t + min(512, max(1, 16384 // lanes)))[:, None]
        known = step < sizes[:lanes]
        from_lane = np.minimum(starts[:lanes] + step, len(stream) - 1)
        target = np.where(known, dealt[from_lane], end)
        now = np.vstack([last[:, :lanes], target[:-1]])
        states, _ = recurrent.run(params, now, now == end, state[:lanes], back=False)
        last, state, t = target[-1:], states[-1], t + len(step)
        held.append((states[known], target[known], from_lane[known]))
        if t < sizes[0] and sum(len(part) for _, part, _ in held) < 16384:
            continue
        flat, target, here = map(np.concatenate, zip(*held))
        member, held = np.where(target < MEMBERS, target, -1), []
        own[here], unknown[here] = recurrent.log_chances(params, flat, _kinds(target), member)
    return own[at], unknown[at]


def _score(model, vocabulary, sums, total: float):
    """Each text's log10 probability under the model and under word counts, but for its words
    outside the head, whose counts a join has to tell; these follow as ``tail``.

    Some two million tokens are scored at once, kept as codes; of words only those outside the head
    are kept as such, one for each time.
    """

    def scored(codes, lengths, tail, ids, serial):
        params, words = model.value, vocabulary.value
        share = np.append(np.log10(words.counts + 0.5), 0.0)
        codes, lengths = np.concatenate(codes), np.concatenate(lengths)
        own, unknown = _logs(params, words.numbers(codes), lengths, words.end)
        own, unknown = own.astype(float) / math.log(10), unknown.astype(float) / math.log(10)
        begin = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.where((codes >= 0) & (codes != _END), codes, len(words.counts))
        head = ranks < len(words.counts)
        base = np.add.reduceat(share[ranks] - head * total, begin)
        apart = np.flatnonzero(head & (codes >= MEMBERS))
        at_tail = np.flatnonzero(codes < 0)
        mine = own.copy()
        mine[apart] += share[codes[apart]] - sums[words.others[codes[apart]]]
        mine[at_tail] = 0
        score = np.add.reduceat(mine, begin)

        tail = pa.concat_arrays(tail).dictionary_encode()
        named = np.asarray(tail.indices).astype(np.int64)
        key = text[at_tail] * max(len(tail.dictionary), 1) + named
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        lists = np.concatenate([[0], np.cumsum(np.bincount(text[at_tail[first]], minlength=len(lengths)))])
        own_tail = own[at_tail] - sums[-1 - codes[at_tail]]
        fields = [
            tail.dictionary.take(pa.array(named[first])),
            pa.array(np.bincount(place, minlength=len(first))),
            pa.array(np.bincount(place, own_tail, len(first))),
            pa.array(np.bincount(place, unknown[at_tail], len(first))),
        ]
        columns = [
            pa.concat_arrays(ids),
            pa.array(serial + np.arange(len(lengths))),
            pa.array(lengths),
            pa.array(np.add.reduceat(head.astype(np.int64), begin)),
            pa.array(base),
            pa.array(score),
            pa.ListArray.from_arrays(
                pa.array(lists.astype(np.int32)),
                pa.StructArray.from_arrays(fields, ["word", "n", "own", "unknown"]),
            ),
        ]
        return pa.RecordBatch.from_arrays(columns, _SCORED)

    def run(batches):
        words = vocabulary.value
        serial = TaskContext.get().partitionId() << 40
        held, size = ([], [], [], []), 0
        for texts, (ids,) in _pieces(batches, ["id"]):
            for own, more in zip(held, (*words.codes(texts), ids)):
                own.append(more)
            size += len(held[0][-1])
            if size > _TOKENS:
                yield scored(*held, serial)
                serial += sum(map(len, held[3]))
                held, size = ([], [], [], []), 0
        if size:
            yield scored(*held, serial)

    return run


_SCORED = ["id", "serial", "n_tokens", "n_head", "base", "model", "tail"]


def score_documents(
    docs: DataFrame,
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hidden: int = 32,
    rounds: int = 3,
    share: int | None = None,
    lanes: int = 512,
    window: int = 32,
    rate: float = 0.02,
) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score``, one row per row of ``docs``.

    All of ``training`` is counted and trains the model. In each of ``rounds`` rounds another one
    in ``share`` of its documents, dealt by hash, does: every task goes on from the common
    parameters with its own documents, and the results are averaged, weighted by tokens. There are
    as many shares as rounds, or fewer, so no document is left out. What is trained on and
    gathered so grows with the corpus; the parameters do not. Only they and the counts of the
    ``HEAD`` most frequent words reach the driver and are broadcast. Of other words the counts
    come by a join. A document is scored as a whole, with the state carried from its first token
    to its end, which is a token too. A null text is empty: the end alone; rows with equal ids or
    texts each get their row, and columns but id and text are ignored.

    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens.
    """
    share = share or rounds
    if share > rounds:
        raise ValueError("more shares than rounds would leave documents out of the training")
    spark = docs.sparkSession
    context = spark.sparkContext
    learned = keyed(training, id_col, text_col).select("k", "text")
    counts = store(count_words(learned), "word-counts")
    ends = learned.count()
    totals = counts.agg(
        F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("n") == 1, 1)).alias("s")
    ).first()
    n = (totals["n"] or 0) + ends
    total = math.log10(n + 0.5 * (totals["v"] + (ends > 0) + 1))
    # No more than ``_SHARES`` words can have such a share of all, so the sort below is bounded.
    frequent = counts.filter(F.col("n") * _SHARES >= n).orderBy(F.desc("n"), "word").limit(HEAD)
    head = [(bytes(r["word"]), r["n"]) for r in frequent.collect()]
    words = Vocabulary(head)
    first = F.conv(F.hex(F.substring("word", 1, _PREFIX)), 16, 10).cast("long")
    kind = (first % OTHERS).cast("int").alias("other")
    grouped = counts.groupBy(kind).agg(
        F.sum("n").alias("n"),
        F.count("*").alias("v"),
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("s"),
    )
    n_other, mass, single = np.zeros(OTHERS), np.zeros(OTHERS), 0
    for r in grouped.collect():
        n_other[r["other"]] = r["n"] - r["s"]
        mass[r["other"]] = r["n"] + 0.5 * r["v"]
        single += r["s"]
    for word, count in head[:MEMBERS]:
        n_other[Vocabulary.other(word)] -= count
        mass[Vocabulary.other(word)] -= count + 0.5
    outside = sum(count for _, count in head)
    outside = max((totals["n"] or 0) - outside, 1)
    member = np.full(MEMBERS, 0.5)
    member[: min(MEMBERS, len(head))] = words.counts[:MEMBERS]
    member = member.reshape(GROUPS, -1)
    sizes = np.concatenate([member.sum(1), np.maximum(n_other, 0) + 0.5, [ends + 0.5, single + 0.5]])
    params = recurrent.start(
        np.log(sizes / sizes.sum()),
        np.log(member / member.sum(1, keepdims=True)),
        MEMBERS + OTHERS + 1,
        hidden,
    )
    vocabulary = context.broadcast(words)
    for number in range(rounds):
        chosen = F.pmod(F.xxhash64("k"), F.lit(share)) == number % share
        shared = context.broadcast(params)
        step = _train(
            shared, vocabulary, min(1.0, single / outside), lanes, window, rate / (1 + number)
        )
        trained = learned.filter(chosen).select("text").mapInArrow(
            step, "block int, salt int, weight double, part binary"
        )
        result = "block int, weight double, part binary"
        averaged = trained.groupBy("block", "salt").applyInArrow(_mean, result)
        averaged = averaged.groupBy("block").applyInArrow(_mean, result)
        blocks = {r["block"]: r["part"] for r in averaged.collect()}
        if blocks:
            vector = b"".join(bytes(blocks[b]) for b in range(len(blocks)))
            params = recurrent.from_vector(np.frombuffer(vector, np.float32), params)
    shared = context.broadcast(params)
    rows = keyed(docs, id_col, text_col).select("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    sums = np.log10(np.maximum(mass, 0.5))
    scored = rows.mapInArrow(
        _score(shared, vocabulary, sums, total),
        f"id {kind}, serial long, n_tokens long, n_head long, base double, model double, "
        "tail array<struct<word:binary,n:long,own:double,unknown:double>>",
    )
    scored = store(scored, "scored")
    tail = scored.select("serial", F.explode("tail").alias("t")).select(
        "serial", F.col("t.word").alias("word"), "t.n", "t.own", "t.unknown"
    )
    c = F.coalesce("c", F.lit(0))
    weight = F.col("n") * F.log10(c + 0.5)
    known = F.col("c").isNotNull()
    rest = (
        tail.join(counts.withColumnRenamed("n", "c"), "word", "left")
        .groupBy("serial")
        .agg(
            F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_rest"),
            F.sum(weight - F.col("n") * total).alias("base_rest"),
            F.sum(F.when(known, F.col("own") + weight).otherwise(F.col("unknown"))).alias("rest"),
        )
    )
    end_known = int(ends > 0)
    end_base = math.log10(ends + 0.5) - total
    zero = F.lit(0)
    return scored.drop("tail").join(rest, "serial", "left").select(
        "id",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", zero) + end_known).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", F.lit(0.0)) + end_base).alias("base_score"),
        (F.col("model") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )
