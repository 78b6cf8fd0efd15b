"""Quality rules whose cutoffs follow the corpus: quantile sketches per language and source.

Only DataFrame functions are used. Each text is measured once, in place; what is shuffled is one
sketch per task, language and source.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.words import SPACE
from usagelens.storage import store

WINDOW = 5
#: Measures with an upper cutoff, and the least spread that is granted to each.
SHARES = {"symbol_share": 0.02, "dup_line_share": 0.1, "repeat_share": 0.1, "capital_share": 0.05}
WORD_CHARS_SPREAD = 0.25
#: In short texts chance has a part: a measure may stray further, by this over the root of a size.
WORD_CHARS_NOISE = 15.0
NOISE = {
    "symbol_share": ("word_chars", 0.6),
    "capital_share": ("word_chars", 0.6),
    "dup_line_share": ("n_lines", 1.0),
    "repeat_share": ("n_words", 1.0),
}
_PREFIX = "_quality_"


def _name(part: str) -> str:
    return _PREFIX + part


def _repeat_words(frame: DataFrame) -> DataFrame:
    """Add the number of words in windows of five that occur twice or more in their text.

    Windows are hashed and sorted with their place, so a text of n words costs n log n. Each place
    that equals a neighbour in that order is marked; the marked windows' union is then measured.
    """
    words, grams, placed, marked = map(_name, ("words", "grams", "placed", "marked"))
    # Every step reads columns of the step before, so that no array is built once per element.
    window = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(WINDOW)]),
    )
    frame = frame.withColumn(grams, F.when(F.size(words) >= WINDOW, window))
    twice = F.size(F.array_distinct(grams)) < F.size(grams)
    pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.withColumn(placed, F.when(twice, pairs))
    hash_at = lambda k: F.get(F.col(placed), k)["h"]
    here = F.filter(
        F.sequence(F.lit(0), F.size(placed) - 1),
        lambda k: (F.coalesce(hash_at(k) == hash_at(k - 1), F.lit(False)))
        | F.coalesce(hash_at(k) == hash_at(k + 1), F.lit(False)),
    )
    places = F.sort_array(F.transform(here, lambda k: F.get(F.col(placed), k)["i"]))
    frame = frame.withColumn(marked, F.when(F.col(placed).isNotNull(), places))
    covered = F.aggregate(
        marked,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"),
            i.alias("last"),
        ),
        lambda a: a["n"],
    )
    count = F.when(F.col(marked).isNotNull(), covered).otherwise(0).cast("long")
    return frame.withColumn(_name("n_repeat_words"), count)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the struct column ``_quality_m`` of counts and shares of each text; a null has no word."""
    text = _name("text")
    words, lines = _name("words"), _name("lines")
    frame = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    frame = frame.withColumn(words, F.array_remove(F.split(text, SPACE), ""))
    solid = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = frame.withColumn(lines, solid)
    frame = _repeat_words(frame)
    n_words = F.size(words).cast("long")
    chars = F.char_length(F.array_join(words, "")).cast("long")
    frame = frame.withColumns(
        {
            _name("n_words"): n_words,
            _name("word_chars"): chars,
            _name("n_symbols"): F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            _name("n_capitals"): F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
            _name("n_lines"): F.size(lines).cast("long"),
            _name("n_dup_lines"): (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        }
    )
    col = lambda c: F.col(_name(c))
    share = lambda a, b: F.when(col(b) > 0, col(a) / col(b)).otherwise(0.0)
    measured = F.struct(
        col("n_words").alias("n_words"),
        col("word_chars").alias("word_chars"),
        col("n_symbols").alias("n_symbols"),
        col("n_lines").alias("n_lines"),
        col("n_dup_lines").alias("n_dup_lines"),
        col("n_repeat_words").alias("n_repeat_words"),
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_capitals", "word_chars").alias("capital_share"),
    )
    return frame.select(*docs.columns, measured.alias(_name("m")))


def base_failed(min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    m = F.col(_name("m"))
    return (m["n_words"] < min_words) | (
        100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"]
    )


def cutoffs(
    measured: DataFrame,
    spreads: float = 3.0,
    min_rows: int = 200,
    sketch_k: int = 400,
) -> DataFrame:
    """Cutoffs per group, from sketches of the rows that the base rules keep.

    A measure may lie ``spreads`` interquartile ranges beyond the quartile. Sketches of groups
    merge: a group of fewer than ``min_rows`` takes those of its language, and a language of fewer
    those of the whole corpus.
    """
    m = F.col(_name("m"))
    usable = measured.filter(~base_failed())
    names = ["mean_word", *SHARES]
    own = usable.groupBy(F.col(_name("g0")).alias("g0"), F.col(_name("g1")).alias("g1")).agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(m[x], sketch_k).alias(x) for x in names],
    )
    own = store(own, "quantile-sketches")
    merged = [F.kll_merge_agg_double(x).alias(f"{x}_1") for x in names]
    language = own.groupBy("g0").agg(F.sum("n").alias("n_1"), *merged)
    whole = language.agg(*[F.kll_merge_agg_double(f"{x}_1").alias(x) for x in names]).first()
    same = F.col("a.g0").eqNullSafe(F.col("b.g0"))
    joined = own.alias("a").join(language.alias("b"), same)

    def quantile(name: str, q: float) -> Column:
        sketch = (
            F.when(F.col("n") >= min_rows, F.col(name))
            .when(F.col("n_1") >= min_rows, F.col(f"{name}_1"))
            .otherwise(F.lit(whole[name]))
        )
        return F.kll_sketch_get_quantile_double(sketch, F.lit(q))

    def fence(name: str, q: float, least: float) -> Column:
        spread = F.greatest(quantile(name, 0.75) - quantile(name, 0.25), F.lit(least))
        return quantile(name, q) + (1 if q > 0.5 else -1) * spreads * spread

    return joined.select(
        F.col("a.g0").alias("g0"),
        F.col("g1"),
        fence("mean_word", 0.25, WORD_CHARS_SPREAD).alias("mean_word_low"),
        fence("mean_word", 0.75, WORD_CHARS_SPREAD).alias("mean_word_high"),
        *[fence(x, 0.75, least).alias(f"{x}_high") for x, least in SHARES.items()],
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    language_col: str = "lang",
    source_col: str = "source",
    carry: list[str] | None = None,
    max_broadcast_groups: int = 100_000,
    **settings,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) with the struct ``_quality_m`` of counts,
    ``_quality_base_failed`` and ``_quality_kept``.

    Null languages and sources are groups of their own. Texts are read whole whatever their length;
    equal rows are judged alike, each a row of the result. A table without usable rows has no
    cutoffs; the base rules alone then decide. The cutoffs, one short row per group, are broadcast
    if there are at most ``max_broadcast_groups`` groups and shuffled beyond that.
    """
    carry = docs.columns if carry is None else carry
    # Columns that are not carried may have any name; of those that are, see ``drop_low_quality``.
    docs = docs.drop(*[c for c in docs.columns if c.startswith(_PREFIX) and c not in carry])
    grouped = docs.withColumns(
        {_name("g0"): F.col(language_col), _name("g1"): F.col(source_col)}
    )
    groups = [_name("g0"), _name("g1")]
    measured = store(measure(grouped, text_col).select(*carry, *groups, _name("m")), "measured")
    limits = store(cutoffs(measured, **settings), "cutoffs")
    if limits.count() <= max_broadcast_groups:
        limits = F.broadcast(limits)
    m = F.col(_name("m"))
    noise = WORD_CHARS_NOISE / F.sqrt(F.greatest(m["n_words"], F.lit(1)))
    fine = m["mean_word"].between(
        F.col("limits.mean_word_low") - noise, F.col("limits.mean_word_high") + noise
    )
    for x in SHARES:
        size, noise = NOISE[x]
        over = noise / F.sqrt(F.greatest(m[size], F.lit(1)))
        fine &= m[x] <= F.col(f"limits.{x}_high") + over
    same = F.col(groups[0]).eqNullSafe(F.col("limits.g0"))
    same &= F.col(groups[1]).eqNullSafe(F.col("limits.g1"))
    failed = base_failed()
    return measured.join(limits.alias("limits"), same, "left").select(
        *carry,
        _name("m"),
        failed.alias(_name("base_failed")),
        (~failed & F.coalesce(fine, F.lit(True))).alias(_name("kept")),
    )


def drop_low_quality(docs: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns, whatever their names."""
    own = {c: "own" + c for c in docs.columns if c.startswith(_PREFIX)}
    while set(own.values()) & set(docs.columns):
        own = {c: "own" + name for c, name in own.items()}
    kept = judge(docs.withColumnsRenamed(own), **columns).filter(_name("kept"))
    return kept.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
