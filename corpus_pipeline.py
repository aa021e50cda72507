"""From raw documents to packed training sequences, one written table per stage.

Every stage reads the documents that its predecessor kept. The first four return
documents with their columns as they came; the last one returns the pieces of all kept
documents with their places in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.llm import decontam, langid, neardup, packing, quality
from fieldmill.llm.common import fold, stage
from fieldmill.llm.queries import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3; a document that scores below LEAST_QUALITY goes."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return quality.keep_good(docs, model, LEAST_QUALITY)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; a document without letters or out of its language's range goes."""
    models = langid.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    return langid.keep_identified(docs, models)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10 on five-word shingles at 0.8; one document of each group stays."""
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7; a document that shares a window with the benchmark goes."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; all documents as pieces with their places in sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# fitted models and the packing have no SQL form; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs, _ = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
