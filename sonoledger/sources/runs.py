"""Outcomes of scoring runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.schemas import JOB_RESULTS
from sonoledger.sources._scan import scan_path


def read_run_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Job rows of saved run summaries (JSON with a ``jobs`` map keyed by window).

    Entries that are not objects are left out. Each summary file is one task's
    work; large runs are better kept as the table of :func:`write_job_results`.
    """

    return parse_run_summary(
        spark.read.text(path, wholetext=True).select(scan_path().alias("summary_path"), "value")
    )


def parse_run_summary(texts: DataFrame) -> DataFrame:
    """Job rows from ``(summary_path, value)`` texts."""

    docs = texts.select("summary_path", F.try_parse_json("value").alias("doc"))
    jobs = docs.select(
        "summary_path",
        F.explode(F.try_variant_get("doc", "$.jobs", "map<string,variant>")),
    )
    fields = [f for f in JOB_RESULTS if f.name != "chunk_id"]
    return jobs.filter(F.schema_of_variant("value").startswith("OBJECT")).select(
        F.col("key").alias("chunk_id"),
        *[
            F.try_variant_get("value", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
            for f in fields
        ],
        "summary_path",
    )


def write_job_results(results: DataFrame, path: str) -> str:
    """Append one row per window to the run table."""

    results.select(*JOB_RESULTS.names).write.mode("append").parquet(path)
    return path


def read_job_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB_RESULTS).parquet(path)


def write_worker_totals(totals: DataFrame, path: str) -> str:
    """Per-worker totals as CSV, ordered by worker."""

    totals.orderBy("worker").coalesce(1).write.mode("overwrite").csv(path, header=True)
    return path
