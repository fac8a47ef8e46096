"""Corpus pipeline: quality rules, one document of each near-duplicate group, personal data
redacted, sources mixed to target weights, sequences packed.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``. ``run``
writes each stage as Parquet to the shared scratch folder and reads it again as
the next one's docs, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunelake.llm import mixing, ngram_join, packing, pii, quality_rules
from tunelake.llm import text as T
from tunelake.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the current policy."""
    return quality_rules.kept_rows(quality_rules.ledger(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by 5-word shingle sets (0.8)."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, spans of personal data replaced by their kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of binary length with their ids."""
    return packing.pack(docs, keep_ids=True)


STAGES = [("quality_rules", quality), ("ngram_jaccard", near_duplicates), ("pii", personal_data), ("mixing", mix),
          ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        at = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # rounding of the mix and the tokenizer have no SQL
