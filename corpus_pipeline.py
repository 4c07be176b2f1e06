"""From documents to a training mix: five stages, each one of the operators of ``recordflow.llm``.

Every stage takes what its predecessor kept, written as Parquet; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm import decontamination, mixing, quality_classifier, simhash, suffix_dedup
from recordflow.llm.base import remainder
from recordflow.operators.batches import shared_dir
from recordflow.plans.registry import query, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 3) != 1)
    return quality_classifier.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_distinct(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur twice or more are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, but for a few edits, go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark),
    ("mixing to target weights", mixture),
]

#: SQL expresses neither the classifier nor the fingerprints; the tests use brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what lies between them is written to the shared folder."""
    docs, base = table(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/stage={k}")
            docs = spark.read.parquet(f"{base}/stage={k}")
    return docs
