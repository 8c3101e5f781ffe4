"""Report tables over detections.

Every report takes either the detections table or its :func:`rollup`. Grouping
is always on the raw column; texts are defaulted for display afterwards, so NULL
and empty names stay two groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoledger.functions.scalars import (
    blank_to_null,
    bucket_index,
    bucket_label,
    bucket_minutes_floor,
    first_text,
)

# Accepted group keys and default report sizes.
SUMMARY_KEYS = ("label", "recording_id")
QUICKLOOK_LABELS, QUICKLOOK_RECORDINGS = 10, 5
TABLE_LABELS, TABLE_RECORDINGS = 20, 10
DATABASE_LABELS, DATABASE_RECORDINGS = 15, 10
SUMMARY_LIMIT = 20
DEFAULT_BUCKET_MINUTES = 60

_GRAIN = ["recording_id", "chunk_id", "chunk_start_ms", "label", "label_name"]
ROLLED = "rolled_detections"


def rollup(detections: DataFrame) -> DataFrame:
    """Counts and confidence sums per (recording, window, label).

    The finest grain any report groups by. One scan with in-task combining makes
    this table; the report family then reads it instead of the detections.
    """

    return detections.groupBy(*_GRAIN).agg(
        F.count("*").alias(ROLLED),
        F.sum("confidence").alias("confidence_sum"),
        F.count("confidence").alias("confidence_count"),
    )


def is_rolled(df: DataFrame) -> bool:
    return ROLLED in df.columns


def _count(df: DataFrame) -> Column:
    return F.sum(ROLLED) if is_rolled(df) else F.count("*")


def _mean(df: DataFrame) -> Column:
    if is_rolled(df):
        return F.try_divide(F.sum("confidence_sum"), F.sum("confidence_count"))
    return F.avg("confidence")


def _grouped(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        _count(df).alias("detections"), _mean(df).alias("avg_confidence")
    )


def _top(df: DataFrame, limit: int | None, *ties: str) -> DataFrame:
    ordered = df.orderBy(F.desc("detections"), *[F.asc_nulls_first(t) for t in ties])
    return ordered if limit is None else ordered.limit(max(1, limit))


def summarize(detections: DataFrame, group_by: Sequence[str] | None = None) -> DataFrame:
    """Counts and mean confidence by label and/or recording."""

    keys = list(group_by) if group_by else ["label"]
    unknown = [k for k in keys if k not in SUMMARY_KEYS]
    if unknown:
        raise ValueError(f"unsupported group keys: {', '.join(unknown)}")
    return _top(_grouped(detections, *keys), None, *keys)


def label_leaderboard(
    detections: DataFrame, limit: int | None = None, names: str = "null"
) -> DataFrame:
    """Labels by number of detections.

    ``names`` says how a missing label name shows: ``'null'`` (reports),
    ``'blank'`` (stored views) or ``'raw'`` (as grouped).
    """

    shown = {
        "null": blank_to_null("label_name"),
        "blank": F.coalesce("label_name", F.lit("")),
        "raw": F.col("label_name"),
    }[names]
    top = _top(_grouped(detections, "label", "label_name"), limit, "label", "label_name")
    return top.select("label", shown.alias("label_name"), "detections", "avg_confidence")


def recording_leaderboard(
    detections: DataFrame, limit: int | None = None, default_names: bool = True
) -> DataFrame:
    """Recordings by number of detections."""

    top = _top(_grouped(detections, "recording_id"), limit, "recording_id")
    shown = first_text("recording_id", F.lit("unknown")) if default_names else F.col("recording_id")
    return top.select(shown.alias("recording_id"), "detections", "avg_confidence")


def chunk_timeline(detections: DataFrame) -> DataFrame:
    """Windows in time order, those without a start first."""

    return (
        detections.groupBy("chunk_id")
        .agg(
            F.min("chunk_start_ms").alias("chunk_start_ms"),
            _count(detections).alias("detections"),
            _mean(detections).alias("avg_confidence"),
        )
        .orderBy(F.asc_nulls_first("chunk_start_ms"), F.asc_nulls_first("chunk_id"))
    )


def bucket_timeline(
    detections: DataFrame, bucket_minutes: int = DEFAULT_BUCKET_MINUTES
) -> DataFrame:
    """Fixed-width time buckets; confidence is the plain mean of window means.

    Level one groups by window and raw start. Level two adds up buckets, which
    are few: only one partial row per bucket and task crosses the shuffle.
    """

    windows = _grouped(detections, "chunk_id", "chunk_start_ms")
    start = F.coalesce("chunk_start_ms", F.lit(0))
    return (
        windows.select(
            bucket_index("chunk_start_ms", bucket_minutes).alias("bucket_index"),
            start.alias("start_ms"),
            "detections",
            "avg_confidence",
        )
        .groupBy("bucket_index")
        .agg(
            F.min("start_ms").alias("bucket_start_ms"),
            F.sum("detections").alias("detections"),
            F.avg("avg_confidence").alias("avg_confidence"),
        )
        .orderBy("bucket_start_ms", "bucket_index")
    )


def named_buckets(timeline: DataFrame) -> DataFrame:
    """The bucket timeline with display names instead of indexes."""

    return timeline.select(
        bucket_label("bucket_index").alias("bucket"),
        "bucket_start_ms",
        "detections",
        "avg_confidence",
    )


def global_summary(
    detections: DataFrame,
    bucket_minutes: int = DEFAULT_BUCKET_MINUTES,
    approximate: bool = False,
) -> DataFrame:
    """One row of totals.

    Exact distinct counts go through a (label, recording) grouping first, so the
    row expansion that two DISTINCT counts need happens on that small table and
    not on the scan. ``approximate`` uses sketches in a single pass.
    """

    if approximate:
        source = detections
        labels = F.approx_count_distinct("label")
        recordings = F.approx_count_distinct("recording_id")
        total = _count(detections)
        first, last = F.min("chunk_start_ms"), F.max("chunk_start_ms")
    else:
        source = detections.groupBy("label", "recording_id").agg(
            _count(detections).alias("n"),
            F.min("chunk_start_ms").alias("first_ms"),
            F.max("chunk_start_ms").alias("last_ms"),
        )
        labels, recordings = F.count_distinct("label"), F.count_distinct("recording_id")
        total = F.coalesce(F.sum("n"), F.lit(0))
        first, last = F.min("first_ms"), F.max("last_ms")
    return source.agg(
        F.coalesce(total, F.lit(0)).alias("detections"),
        labels.alias("label_count"),
        recordings.alias("recording_count"),
        first.alias("first_chunk_ms"),
        last.alias("last_chunk_ms"),
    ).withColumn("bucket_minutes", F.lit(bucket_minutes_floor(bucket_minutes)))


def timeline_sparkline(timeline: DataFrame, max_width: int = 80) -> DataFrame:
    """One row: the bucket counts drawn as a line of text.

    Buckets are one value per time step of a recording-length axis, which bounds
    the array by the longest recording over the bucket width.
    """

    from sonoledger.functions.sparkline import sparkline

    order = F.struct("bucket_start_ms", "bucket_index", "detections")
    series = timeline.agg(F.array_sort(F.collect_list(order)).alias("s"))
    counts = F.transform("s", lambda p: p["detections"].cast("double"))
    return series.select(
        sparkline(counts, width=max_width).alias("sparkline"), F.size("s").alias("buckets")
    )


def folder_rollup(
    detections: DataFrame, limit: int = 20
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels, recordings and totals over many exports; names stay as stored."""

    if limit <= 0:
        raise ValueError("limit must be positive")
    labels = label_leaderboard(detections, limit, names="raw").select(
        "label_name", "label", "detections", "avg_confidence"
    )
    recordings = recording_leaderboard(detections, limit, default_names=False)
    totals = global_summary(detections).select("detections", "recording_count")
    return labels, recordings, totals


@dataclass(frozen=True)
class Quicklook:
    top_labels: DataFrame
    top_recordings: DataFrame
    chunk_timeline: DataFrame


@dataclass(frozen=True)
class TableReport:
    labels: DataFrame
    recordings: DataFrame
    timeline: DataFrame
    summary: DataFrame


@dataclass(frozen=True)
class DatabaseReport:
    labels: DataFrame
    recordings: DataFrame
    timeline: DataFrame
    summary: DataFrame
    sparkline: DataFrame


def quicklook(
    detections: DataFrame, top_labels: int = QUICKLOOK_LABELS, top_recordings: int | None = None
) -> Quicklook:
    """Top labels, top recordings (as many by default) and the window timeline."""

    return Quicklook(
        label_leaderboard(detections, top_labels),
        recording_leaderboard(detections, top_recordings or top_labels),
        chunk_timeline(detections),
    )


def table_report(
    detections: DataFrame,
    top_labels: int = TABLE_LABELS,
    top_recordings: int = TABLE_RECORDINGS,
    bucket_minutes: int = DEFAULT_BUCKET_MINUTES,
) -> TableReport:
    return TableReport(
        label_leaderboard(detections, top_labels),
        recording_leaderboard(detections, top_recordings),
        named_buckets(bucket_timeline(detections, bucket_minutes)),
        global_summary(detections, bucket_minutes),
    )


def database_report(
    detections: DataFrame,
    top_labels: int = DATABASE_LABELS,
    top_recordings: int = DATABASE_RECORDINGS,
    bucket_minutes: int = DEFAULT_BUCKET_MINUTES,
) -> DatabaseReport:
    timeline = bucket_timeline(detections, bucket_minutes)
    return DatabaseReport(
        label_leaderboard(detections, top_labels, names="blank"),
        recording_leaderboard(detections, top_recordings, default_names=False),
        timeline,
        global_summary(detections, bucket_minutes),
        timeline_sparkline(timeline),
    )
