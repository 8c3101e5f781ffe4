"""Corpus pipeline: documents through five stages, each written as Parquet and read again.

toxicity         documents scored 0.5 or more go
near_duplicates  one document of each near-duplicate class stays
decontamination  documents that hold a window of a benchmark item go
secrets          secrets in the texts are replaced, no document goes
sentencepiece    token counts and digests of what is left

All but the last stage return the columns of their input. The models are trained on the
stage's own input (labels from the ``labels`` table) and never see a row that is not in it.
Rows with null or empty texts pass every filter, but for repeated empty texts, which are
copies. An empty table passes through all stages.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sonoledger.llm import secrets_scan, toxicity
from sonoledger.llm.decontaminate import drop_contaminated
from sonoledger.llm.near_dup import drop_near_duplicates
from sonoledger.llm.pieces import encode_texts
from sonoledger.llm.queries import ARROW_ROWS, piece_model, table
from sonoledger.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """The stage with texts going to Python in small batches, so that workers stay small."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


@small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact(docs, secrets_scan.train(docs))


@small_batches
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, piece_model())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", encoding_stage),
]

# Trained models decide in two stages, which SQL can't express; tests hold the stages
# against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
