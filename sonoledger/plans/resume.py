"""Skipping windows an earlier run has finished."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resume_entries(results: DataFrame) -> DataFrame:
    """Distinct ``(recording_id, chunk_id)`` of successful windows; recording may be NULL."""

    return results.filter(F.col("status") == "success").select("recording_id", "chunk_id").distinct()


def pending_jobs(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """Jobs not covered by an entry.

    An entry with a recording covers that window of that recording; one without
    covers the window id anywhere. Two anti-joins say this without an OR in the
    join condition, which would rule out hash and merge joins.
    """

    keyed = entries.filter(F.col("recording_id").isNotNull())
    anywhere = entries.filter(F.col("recording_id").isNull()).select("chunk_id")
    return jobs.join(keyed, ["recording_id", "chunk_id"], "left_anti").join(anywhere, "chunk_id", "left_anti").select(
        *jobs.columns
    )


def orphan_counts(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: entries, jobs skipped, and entries left over (never below zero).

    Counted by subtraction, which equals the entries without a job only where
    window ids are unique; :func:`unmatched_entries` is the exact form.
    """

    zero = F.lit(0).cast("bigint")
    parts = (
        entries.agg(F.count("*").alias("entries"))
        .select("entries", zero.alias("jobs"), zero.alias("pending"))
        .unionByName(
            jobs.agg(F.count("*").alias("jobs")).select(
                zero.alias("entries"), "jobs", zero.alias("pending")
            )
        )
        .unionByName(
            pending_jobs(jobs, entries)
            .agg(F.count("*").alias("pending"))
            .select(zero.alias("entries"), zero.alias("jobs"), "pending")
        )
    )
    total = parts.agg(
        F.sum("entries").alias("entries"), (F.sum("jobs") - F.sum("pending")).alias("skipped")
    )
    return total.withColumn(
        "orphaned", F.greatest(F.col("entries") - F.col("skipped"), F.lit(0).cast("bigint"))
    )


def unmatched_entries(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries that no job of this manifest corresponds to."""

    keyed = entries.filter(F.col("recording_id").isNotNull()).join(
        jobs.select("recording_id", "chunk_id"), ["recording_id", "chunk_id"], "left_anti"
    )
    anywhere = entries.filter(F.col("recording_id").isNull()).join(
        jobs.select("chunk_id"), "chunk_id", "left_anti"
    )
    return keyed.unionByName(anywhere)
