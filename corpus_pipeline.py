"""From raw documents to packed training sequences.

``STAGES`` names the stages in order. Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents; all but the last return the columns of ``documents``. Nulls,
empty texts, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clientele.llm import mixing, packing, pii, quality, resemblance
from clientele.llm.common import table
from clientele.sources.scratch import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it learns from ``labels``, held-out rows apart."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near-duplicates.

    SimHash with pivots on candidates, then similarities of 0.8 on five words.
    """
    return resemblance.one_of_each(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every source's documents as often as its target weight asks."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences; copies of a document are documents of their own."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality", good),
    ("near_duplicates", one_of_each),
    ("personal_data", redacted),
    ("mix", mixed),
    ("pack", packed),
]

#: A trained tagger and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
