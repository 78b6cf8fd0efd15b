"""The registered queries of the operators, and SQL for those that SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import bpe
from usagelens.llm.divergence import source_divergence
from usagelens.llm.exact_dedup import exact_groups
from usagelens.llm.language_model import score_documents
from usagelens.llm.line_dedup import drop_boilerplate
from usagelens.llm.mixing import mix
from usagelens.llm.packing import added_tokens, pack_documents
from usagelens.llm.periodic_runs import periodic_runs
from usagelens.llm.quality_model import grade_documents
from usagelens.llm.quality_rules import judge
from usagelens.llm.simhash import near_groups
from usagelens.llm.substring_dedup import repeated_passages
from usagelens.llm.toxicity import toxicity
from usagelens.llm.words import SPACE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLE_SQL[function.__name__] = oracle
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(id_col: str = "doc_id") -> Column:
    """The fold of a document; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


@_query("""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(_table(spark, sf_dir, "documents"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return groups.withColumn("copy", copy).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("kept") & (F.col("copy") == 1)).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


@_query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    judged = judge(docs, carry=["doc_id"]).select(
        "doc_id",
        *[f"_quality_m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")],
        "_quality_m.n_repeat_words",
        F.col("_quality_base_failed").alias("base_failed"),
        F.col("_quality_kept").alias("kept"),
    )
    return judged


@_query("""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source),
w AS (SELECT *, (place - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *,
         ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (
            ORDER BY 3 * source_size / weight, place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, place
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, place,
         least(CAST(3 * source_size AS DOUBLE), (SELECT max(level) FROM l) * weight) AS target
  FROM l),
c AS (
  SELECT doc_id, key, size, source_size, target, place,
         sum(size) OVER (PARTITION BY place ORDER BY key, size
                         ROWS UNBOUNDED PRECEDING) AS served
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (
  SELECT doc_id, key, size, sum(size) OVER (
           ORDER BY (p * source_size + served) / target, place, key, p
           ROWS UNBOUNDED PRECEDING) AS upto
  FROM c, (VALUES (0), (1), (2)) AS passes(p) WHERE size > 0),
k AS (
  SELECT key, sum(CASE WHEN upto <= (SELECT sum(source_size) FROM t) THEN size ELSE 0 END) AS taken
  FROM i GROUP BY key)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM c LEFT JOIN k USING (key)
""")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@_query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@_query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    packed = pack_documents(_table(spark, sf_dir, "documents"), tokenizer, added=added)
    return packed.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@_query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@_query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").filter(_remainder() != 0)
    scored = toxicity(_table(spark, sf_dir, "documents"), labels)
    held_out = (_remainder("id") == 0).alias("held_out")
    return scored.select(F.col("id").alias("doc_id"), held_out, "score", "predicted")


@_query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 of low quality, 1 of good quality but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    ratings = _table(spark, sf_dir, "labels").filter(_remainder() != 0)
    graded = grade_documents(
        _table(spark, sf_dir, "documents"), ratings.select("doc_id", grade.alias("grade"))
    )
    return graded.select(
        F.col("id").alias("doc_id"),
        (_remainder("id") == 0).alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= 0.5).alias("kept"),
    )


@_query("""
WITH l AS (
  SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents)),
t AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM l),
b AS (
  SELECT body, true AS gone FROM t WHERE body <> ''
  GROUP BY body HAVING count(DISTINCT coalesce(source, chr(1))) >= 10)
SELECT doc_id, count(*) FILTER (body <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone IS NULL), ''))
         AS kept_sha256
FROM t LEFT JOIN b USING (body) GROUP BY doc_id
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_boilerplate(_table(spark, sf_dir, "documents"))
    return cleaned.select(
        F.col("id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@_query()
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_documents(docs, docs.filter(_remainder() != 1))
    return scored.select(
        F.col("id").alias("doc_id"),
        (_remainder("id") == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def _planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents all words from one on repeat with a period."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(hashed / 10)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    planted = (
        docs.filter(hashed % 10 == 0)
        .select("doc_id", g.alias("g"), words.alias("words"))
        .withColumn("n", F.size("words"))
        .filter("n > 0")
        .withColumn("a", (F.col("g") % F.col("n")).cast("int"))
        .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    )
    cycle, left = F.slice("words", F.col("a") + 1, F.col("p")), F.col("n") - F.col("a")
    times = F.ceil(left / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), left)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    planted = planted.select("doc_id", text.alias("text"))
    # A text without words has none to repeat either.
    other = (hashed % 10 != 0) | F.col("text").isNull() | (F.size(words) == 0)
    return planted.unionByName(docs.filter(other).select("doc_id", "text"))


@_query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_planted(_table(spark, sf_dir, "documents")))
    ordered = F.array_min(
        F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start, r.period))
    )
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    length = -F.col("best.l")
    return found.withColumn("best", ordered).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.call_function("div", 1000 * length, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@_query()
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), tokenizer)
    return bpe.decode(encoded, tokenizer).select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query("""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents),
w AS (
  SELECT r, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term)
      GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (
  SELECT lang, source, coalesce(n, 0) + 2 * v AS size
  FROM g JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source) USING (lang, source)),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
         CAST(1 + (1000000000 * (coalesce(c, 0) + 2)) // size AS BIGINT) AS p
  FROM n JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (
  SELECT lang, term, CAST(1 + (1000000000 * (sum(c) + 2))
           // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang))
         AS BIGINT) AS q
  FROM c GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 10
""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))
