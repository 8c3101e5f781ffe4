"""Cutting recordings into fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoledger.functions.paths import stem
from sonoledger.functions.scalars import chunk_key
from sonoledger.sources.manifests import HASH_DRY_RUN, HASH_PENDING

# Windows numbered per inner sequence: bounds the array any one row carries.
WINDOW_BLOCK = 4096
# Rows handed back from Python at a time.
OUTPUT_ROWS = 65536
PREVIEW_WINDOWS = 3


def _check(duration_s: float, overlap_s: float = 0.0) -> None:
    if duration_s <= 0:
        raise ValueError("window duration must be positive")
    if overlap_s < 0:
        raise ValueError("overlap cannot be negative")


def _numbered(rows: DataFrame, count: Column, spread: int | None) -> DataFrame:
    """Explode 0..count-1 as ``k`` in two steps.

    The first step yields one row per block of windows. With ``spread`` those
    block rows are redistributed, so one very long recording is worked on by many
    tasks; either way no row holds a sequence longer than a block.
    """

    blocks = F.ceil(count / F.lit(WINDOW_BLOCK)).cast("bigint")
    rows = rows.withColumn("_n", count).filter(F.col("_n") > 0)
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    if spread:
        rows = rows.repartition(spread)
    first = F.col("_block") * WINDOW_BLOCK
    last = F.least(first + WINDOW_BLOCK, F.col("_n")) - 1
    return rows.withColumn("k", F.explode(F.sequence(first, last))).drop("_block", "_n")


def plan_windows(
    recordings: DataFrame,
    duration_s: float,
    overlap_s: float = 0.0,
    chunks_dir: str | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Frame-exact windows per recording, optionally overlapping.

    ``recordings`` needs ``recording_id, audio_path, sample_rate, n_frames``.
    Starts are a step apart and every start below the end gives a window, so the
    last one may lie inside the one before it. An overlap that is not shorter
    than the window is ignored for the step.
    """

    _check(duration_s, overlap_s)
    rate = F.col("sample_rate")
    size = F.greatest((F.lit(float(duration_s)) * rate).cast("bigint"), F.lit(1).cast("bigint"))
    lap = F.greatest((F.lit(float(overlap_s)) * rate).cast("bigint"), F.lit(0).cast("bigint"))
    sized = (
        recordings.filter((rate > 0) & (F.col("n_frames") > 0))
        .withColumns({"_size": size, "_lap": lap})
        .withColumn(
            "_step", F.when(F.col("_size") <= F.col("_lap"), F.col("_size")).otherwise(
                F.col("_size") - F.col("_lap")
            )
        )
    )
    count = F.ceil(F.col("n_frames") / F.col("_step")).cast("bigint")
    windows = (
        _numbered(sized, count, spread)
        .withColumn("start_frame", F.col("k") * F.col("_step"))
        .withColumn("end_frame", F.least(F.col("start_frame") + F.col("_size"), F.col("n_frames")))
    )

    def to_ms(frame: str) -> Column:
        return (F.col(frame) / rate * 1000).cast("bigint")

    windows = windows.withColumns(
        {
            "start_ms": to_ms("start_frame"),
            "end_ms": to_ms("end_frame"),
            "overlap_ms": to_ms("_lap"),
        }
    )
    ids = windows.withColumn(
        "chunk_id", chunk_key("recording_id", F.col("start_ms"), F.col("end_ms"))
    )
    return _with_source(ids, chunks_dir).drop("_size", "_lap", "_step", "k")


def _with_source(windows: DataFrame, chunks_dir: str | None) -> DataFrame:
    """Where the window's audio lies: its own file, else the whole recording."""

    if chunks_dir is None:
        return windows.withColumn("source_path", F.col("audio_path"))
    return windows.withColumn(
        "source_path",
        F.concat(
            F.lit(chunks_dir.rstrip("/") + "/"),
            F.col("recording_id"),
            F.lit("/"),
            F.col("chunk_id"),
            F.lit(".wav"),
        ),
    )


def products_are_exact(duration_s: float, longest_s: float = 2.0**31) -> bool:
    """Whether multiples of the duration are exact doubles up to ``longest_s``.

    Then adding it up step by step and multiplying give the same starts.
    """

    denominator = float(duration_s).as_integer_ratio()[1]
    return longest_s * denominator < 2.0**53


def plan_windows_seconds(
    recordings: DataFrame,
    duration_s: float,
    overlap_ms: int = 0,
    chunks_dir: str | None = None,
    dry_run: bool = False,
    exact_fold: bool | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Windows from a recording's length in seconds, without overlap in the step.

    ``recordings`` needs ``recording_id, audio_path, duration_s``. Starts are
    defined by adding the duration repeatedly. ``exact_fold`` (default: only
    where it can differ) follows that addition to the last bit; multiplication
    is used otherwise. ``dry_run`` names windows like written ones, marks them
    and records the overlap asked for.
    """

    _check(duration_s)
    fold = not products_are_exact(duration_s) if exact_fold is None else exact_fold
    rows = recordings.withColumn("duration_s", F.col("duration_s").cast("double")).filter(
        F.col("duration_s") > 0
    )
    if fold:
        carried = rows.select("recording_id", "audio_path", "duration_s")
        bounds = _folded(carried, float(duration_s))
    else:
        step = F.lit(float(duration_s))
        count = F.ceil(F.col("duration_s") / step).cast("bigint")
        bounds = (
            _numbered(rows, count, spread)
            .withColumn("start_s", F.col("k") * step)
            .filter(F.col("start_s") < F.col("duration_s"))
            .withColumn("end_s", F.least((F.col("k") + 1) * step, F.col("duration_s")))
        )
    windows = bounds.withColumns(
        {
            "start_ms": (F.col("start_s") * 1000).cast("bigint"),
            "end_ms": (F.col("end_s") * 1000).cast("bigint"),
            "overlap_ms": F.lit(overlap_ms if dry_run else 0).cast("bigint"),
            "sha256": F.lit(HASH_DRY_RUN if dry_run else HASH_PENDING),
        }
    ).withColumn(
        "chunk_id",
        chunk_key(
            "recording_id",
            F.col("start_ms"),
            F.col("end_ms"),
            infix="_chunk_" if dry_run else "_",
        ),
    )
    return _with_source(windows, chunks_dir if dry_run else None).select(
        "recording_id", "chunk_id", "source_path", "start_s", "end_s", "start_ms", "end_ms",
        "overlap_ms", "sha256",
    )


def _folded(rows: DataFrame, step: float) -> DataFrame:
    """Window bounds by running addition.

    The edges depend on the step alone, so a task adds them up once, as far as
    its longest recording needs, and looks up every recording's share of them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges = np.zeros(1)
        for batch in batches:
            lengths = batch.duration_s.to_numpy()
            while len(lengths) and edges[-1] < lengths.max():
                more = np.full(max(WINDOW_BLOCK, len(edges)), step)
                edges = np.r_[edges[:-1], np.add.accumulate(np.r_[edges[-1], more])]
            counts = np.searchsorted(edges, lengths, side="left")
            ends = np.cumsum(counts)
            for first in range(0, int(ends[-1]) if len(ends) else 0, OUTPUT_ROWS):
                place = np.arange(first, min(first + OUTPUT_ROWS, ends[-1]))
                owner = np.searchsorted(ends, place, side="right")
                k = place - (ends - counts)[owner]
                yield pd.DataFrame(
                    {
                        "recording_id": batch.recording_id.to_numpy()[owner],
                        "audio_path": batch.audio_path.to_numpy()[owner],
                        "k": k,
                        "start_s": edges[k],
                        "end_s": np.minimum(edges[k + 1], lengths[owner]),
                    }
                )

    return rows.mapInPandas(
        run, "recording_id STRING, audio_path STRING, k BIGINT, start_s DOUBLE, end_s DOUBLE"
    )


def preview_windows(recordings: DataFrame, duration_s: float) -> DataFrame:
    """Ids, in whole seconds, of the first three windows of the given length."""

    _check(duration_s)
    name = stem("audio_path") if "audio_path" in recordings.columns else F.col("recording_id")
    probe = recordings.withColumns(
        {
            "recording_id": name,
            "audio_path": name,
            "duration_s": F.lit(duration_s * PREVIEW_WINDOWS),
        }
    )
    bounds = plan_windows_seconds(probe, duration_s)
    return bounds.select(
        "recording_id",
        chunk_key(
            "recording_id", F.col("start_s").cast("bigint"), F.col("end_s").cast("bigint"), "_"
        ).alias("chunk_id"),
    )


def rows_per_recording(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("recording_id").agg(F.count("*").alias("manifest_rows"))


def detections_per_chunk(names: DataFrame, column: str = "detection") -> DataFrame:
    """Count detection names by the text before ``_detected``."""

    chunk = F.element_at(F.split(F.col(column), "_detected"), 1)
    return names.groupBy(chunk.alias("chunk_id")).agg(F.count("*").alias("detections"))
