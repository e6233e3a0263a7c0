"""A training corpus from the raw documents: the stages in order, each stored and read again.

Every stage works on all that the one before kept. All but the last return the columns of
``documents``; the last returns the mix itself, one row per copy, numbered in ``copy``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.llm import decontaminate, line_dedup, mixing, quality, simhash
from velomart.llm.common import unused
from velomart.llm.queries import (
    BUDGET,
    EDIT_SIMILARITY,
    MAX_BITS,
    MIN_RUN_WORDS,
    MOST_COPIES,
    RECALL,
    SHINGLE_WORDS,
    WEIGHTS,
)
from velomart.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs go; a document that has no word left goes with them."""
    text, spans = unused("kept_text", docs.columns), unused("deleted_spans", docs.columns)
    found = line_dedup.dedup_lines(docs, min_words=MIN_RUN_WORDS, kept_col=text, spans_col=spans)
    changed = F.size(spans) > 0
    found = found.where(~changed | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        size = F.length(text).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, shingle_words=SHINGLE_WORDS, radius=MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items, similarity=EDIT_SIMILARITY, recall=RECALL)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight has it drawn."""
    return mixing.mix(docs, weights=WEIGHTS, budget=BUDGET, most=MOST_COPIES)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mix),
]

#: The classifier, the edit distances and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
