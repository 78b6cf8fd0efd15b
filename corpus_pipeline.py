"""The corpus pipeline: stages over ``documents``, each applied to all that the one before kept.

Every stage takes the session, the documents so far and the folder of the tables. All but the last
return rows with the columns of the documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from usagelens.llm.exact_dedup import drop_exact_copies
from usagelens.llm.mixing import take_mix
from usagelens.llm.packing import added_tokens, pack_documents
from usagelens.llm.quality_rules import drop_low_quality
from usagelens.llm.simhash import drop_near_copies
from usagelens.storage import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed or the adaptive rules reject go."""
    return drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints of 3-word shingles that differ in 2 bits or
    fewer the one with the smallest id stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their targets; a document served more than once is a row each time."""
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, their ids and their place in a sequence, one row per piece."""
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), added=added)
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing sources", mixing),
    ("packing", packing),
]

#: SQL expresses neither the sketches nor the fingerprints and tokens; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
