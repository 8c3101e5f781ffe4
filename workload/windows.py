"""Cutting recordings into windows, audio blobs and the memory probe."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from sonoledger.operators.audio import cut_windows, export_wav_files, manifest_from_blobs
from sonoledger.operators.probe import probe_attempts, probe_windows
from sonoledger.operators.windows import (
    detections_per_chunk,
    plan_windows,
    plan_windows_seconds,
    preview_windows,
    rows_per_recording,
)
from sonoledger.session import materialise, shared_dir
from sonoledger.sources.recordings import discover_recordings, read_wav_headers
from workload.proxies import RECORDINGS_SQL, recordings, table

_SHOWN = ["recording_id", "chunk_id", "source_path", "start_ms", "end_ms", "overlap_ms"]


def frame_windows(spark, sf_dir):
    return plan_windows(recordings(spark, sf_dir), 60.0, 10.0).select(*_SHOWN)


def frame_windows_wide_overlap(spark, sf_dir):
    """An overlap longer than the window does not shorten the step."""

    windows = plan_windows(recordings(spark, sf_dir), 45.5, 50.0, chunks_dir="/chunks")
    return windows.select(*_SHOWN)


def second_windows(spark, sf_dir):
    return plan_windows_seconds(recordings(spark, sf_dir), 30.0).select(*_SHOWN, "sha256")


def second_windows_folded(spark, sf_dir):
    """A length whose multiples are not exact: starts come from running addition."""

    return plan_windows_seconds(recordings(spark, sf_dir), 7.3).select(*_SHOWN, "sha256")


def dry_run_windows(spark, sf_dir):
    windows = plan_windows_seconds(
        recordings(spark, sf_dir), 60.0, overlap_ms=5000, chunks_dir="/chunks", dry_run=True
    )
    return windows.select(*_SHOWN, "sha256")


def window_preview(spark, sf_dir):
    return preview_windows(recordings(spark, sf_dir), 60.0)


def manifest_row_counts(spark, sf_dir):
    return rows_per_recording(plan_windows(recordings(spark, sf_dir), 60.0, 10.0))


def detections_by_prefix(spark, sf_dir):
    names = table(spark, sf_dir, "events").select(
        F.concat(F.lit("chunk_"), "user_id", F.lit("_detected_"), "event_id").alias("detection")
    )
    return detections_per_chunk(names)


def _devices(spark, sf_dir):
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey AS bigint) AS gpu_index", "n_name AS gpu_name",
        "cast(0.25 * (n_nationkey + 1) AS double) AS memory_total_mb",
    )


def _probe(spark, sf_dir):
    recs = recordings(spark, sf_dir).withColumns(
        {
            "gpu_index": F.expr("if(doc_id % 4 = 0, NULL, doc_id % 30)"),
            "sample_rate": F.lit(1000),
        }
    )
    return probe_windows(recs, _devices(spark, sf_dir))


def window_probe(spark, sf_dir):
    return _probe(spark, sf_dir).select(
        "recording_id", "gpu_index", "gpu_name",
        F.round("search_s", 9).alias("search_s"),
        (F.abs(F.col("max_duration_s") - F.col("search_s")) < 0.00501).alias("rounded"),
        F.round("bound_s", 6).alias("bound_s"), "notes",
    )


def window_probe_attempts(spark, sf_dir):
    return probe_attempts(_probe(spark, sf_dir)).select(
        "recording_id", "attempt", F.round("duration_s", 9).alias("duration_s"),
        F.round("estimated_vram_mb", 9).alias("estimated_vram_mb"), "fits",
    )


# ---- audio: document texts as 8-bit samples --------------------------------------------


def write_audio(spark, sf_dir, root: str, name: str):
    """One WAV file per row of a table, whose text is the sample data."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blobs = []
            for data in batch.data:
                buf = io.BytesIO()
                with wave.open(buf, "wb") as out:
                    out.setnchannels(1)
                    out.setsampwidth(1)
                    out.setframerate(10)
                    out.writeframes(data)
                blobs.append(buf.getvalue())
            yield pd.DataFrame(
                {"chunk_id": batch.id, "source_path": batch.path, "content": blobs}
            )

    rows = table(spark, sf_dir, name).select(
        F.concat(F.lit("rec_"), F.col("item_id")).alias("id"),
        F.concat(
            F.lit(f"{root}/audio/g"), F.col("item_id") % 4, F.lit("/rec_"), F.col("item_id"),
            F.lit(".wav"),
        ).alias("path"),
        F.col("text").cast("binary").alias("data"),
    )
    blobs = rows.mapInPandas(build, "chunk_id STRING, source_path STRING, content BINARY")
    export_wav_files(blobs).write.format("noop").mode("overwrite").save()


def _facts(spark, sf_dir):
    root = shared_dir(spark, "audio").removeprefix("file://")
    write_audio(spark, sf_dir, root, "benchmark")
    return materialise(read_wav_headers(discover_recordings(spark, root)), "recordings")


def recording_headers(spark, sf_dir):
    return _facts(spark, sf_dir).select(
        "recording_id", "channels", "sample_rate", "sample_width_bytes", "data_offset", "n_frames",
        "duration_s", "error",
    )


def window_audio(spark, sf_dir):
    windows = plan_windows(_facts(spark, sf_dir), 3.0, 1.0, chunks_dir="/chunks")
    blobs = cut_windows(windows)
    return blobs.select(
        "recording_id", "chunk_id", "start_ms", "end_ms",
        F.expr("hex(substr(content, 45))").alias("samples"),
        F.expr("length(content)").alias("bytes"),
        (F.sha2("content", 256) == F.col("sha256")).alias("hash_fits"),
    )


def window_audio_manifest(spark, sf_dir):
    windows = plan_windows(_facts(spark, sf_dir), 3.0, 1.0, chunks_dir="/chunks")
    return manifest_from_blobs(cut_windows(windows)).select(
        "recording_id", "chunk_id", "source_path", "start_ms", "end_ms", "overlap_ms",
        F.length("sha256").alias("hash_length"),
    )


QUERIES = {
    "frame_windows": frame_windows,
    "frame_windows_wide_overlap": frame_windows_wide_overlap,
    "second_windows": second_windows,
    "second_windows_folded": second_windows_folded,
    "dry_run_windows": dry_run_windows,
    "window_preview": window_preview,
    "manifest_row_counts": manifest_row_counts,
    "detections_by_prefix": detections_by_prefix,
    "window_probe": window_probe,
    "window_probe_attempts": window_probe_attempts,
    "recording_headers": recording_headers,
    "window_audio": window_audio,
    "window_audio_manifest": window_audio_manifest,
}


def _frames(size: int, step: int, lap_ms: int, source: str) -> str:
    return f"""WITH {RECORDINGS_SQL},
w AS (
  SELECT *, CAST(trunc(s / 10 * 1000) AS BIGINT) AS start_ms,
         CAST(trunc(least(s + {size}, n_frames) / 10 * 1000) AS BIGINT) AS end_ms
  FROM (SELECT *, unnest(range(0, n_frames, {step})) AS s FROM recordings)
),
named AS (SELECT *, recording_id || '_chunk_' || start_ms || '_' || end_ms AS chunk_id FROM w)
SELECT recording_id, chunk_id, {source} AS source_path, start_ms, end_ms,
       CAST({lap_ms} AS BIGINT) AS overlap_ms FROM named"""


_CHUNK_FILE = "'/chunks/' || recording_id || '/' || chunk_id || '.wav'"


def _seconds(length: float, infix: str, source: str, lap: int, mark: str) -> str:
    return f"""WITH {RECORDINGS_SQL},
w AS (
  SELECT *, CAST(trunc(k * {length} * 1000) AS BIGINT) AS start_ms,
         CAST(trunc(least((k + 1) * {length}, duration_s) * 1000) AS BIGINT) AS end_ms
  FROM (SELECT *, unnest(range(0, CAST(ceil(duration_s / {length}) AS BIGINT))) AS k FROM recordings)
),
named AS (SELECT *, recording_id || '{infix}' || start_ms || '_' || end_ms AS chunk_id FROM w)
SELECT recording_id, chunk_id, {source} AS source_path, start_ms, end_ms,
       CAST({lap} AS BIGINT) AS overlap_ms, '{mark}' AS sha256 FROM named"""


_PROBE_SQL = f"""WITH RECURSIVE {RECORDINGS_SQL},
dev AS (SELECT n_nationkey AS gpu_index, n_name AS gpu_name,
               0.25::DOUBLE * (n_nationkey + 1) AS total FROM nation),
r AS (
  SELECT recording_id, greatest(5.0::DOUBLE, duration_s) AS longest,
         1000::DOUBLE * channels * 2 * 4 AS bps, d.gpu_index, d.gpu_name,
         greatest(1.0::DOUBLE, d.total * 0.8::DOUBLE) AS lim
  FROM recordings JOIN dev d
    ON d.gpu_index = CASE WHEN doc_id % 4 = 0 OR doc_id % 30 > 24 THEN 0 ELSE doc_id % 30 END
  WHERE duration_s > 0
),
s AS (
  SELECT *, 1 AS attempt, least(60.0::DOUBLE, longest) AS cand, 0.0::DOUBLE AS low, longest AS high,
         'shrink' AS phase FROM r
  UNION ALL
  SELECT recording_id, longest, bps, gpu_index, gpu_name, lim, attempt + 1,
         CASE WHEN phase2 = 'shrink' THEN greatest(5.0::DOUBLE, cand / 2) ELSE (low2 + high2) / 2 END,
         low2, high2, phase2
  FROM (
    SELECT *, CASE WHEN phase = 'shrink' AND NOT fits AND cand > 5 THEN 'shrink'
                   ELSE 'bisect' END AS phase2
    FROM (
      SELECT *, CASE WHEN fits THEN cand WHEN phase = 'shrink' AND cand <= 5 THEN 5.0::DOUBLE
                     ELSE low END AS low2,
             CASE WHEN fits THEN high ELSE cand END AS high2
      FROM (SELECT *, bps * cand * 1.35::DOUBLE / 1048576 <= lim AS fits FROM s)
    )
  ) WHERE phase2 = 'shrink' OR high2 - low2 > 5
),
tried AS (SELECT *, bps * cand * 1.35::DOUBLE / 1048576 AS mb FROM s)
"""

ORACLE = {
    "frame_windows": _frames(600, 500, 10000, "audio_path"),
    "frame_windows_wide_overlap": _frames(455, 455, 50000, _CHUNK_FILE),
    "second_windows": _seconds(30.0, "_", "audio_path", 0, "TODO_HASH"),
    "second_windows_folded": f"""WITH RECURSIVE {RECORDINGS_SQL},
starts AS (
  SELECT 0.0::DOUBLE AS s
  UNION ALL SELECT s + 7.3::DOUBLE FROM starts
  WHERE s + 7.3::DOUBLE < (SELECT max(n_chars) / 10 FROM documents)
),
w AS (
  SELECT *, CAST(trunc(s * 1000) AS BIGINT) AS start_ms,
         CAST(trunc(least(s + 7.3::DOUBLE, duration_s) * 1000) AS BIGINT) AS end_ms
  FROM recordings JOIN starts ON s < duration_s
)
SELECT recording_id, recording_id || '_' || start_ms || '_' || end_ms AS chunk_id,
       audio_path AS source_path, start_ms, end_ms, CAST(0 AS BIGINT) AS overlap_ms,
       'TODO_HASH' AS sha256 FROM w""",
    "dry_run_windows": _seconds(60.0, "_chunk_", _CHUNK_FILE, 5000, "DRY_RUN"),
    "window_preview": f"""WITH {RECORDINGS_SQL}
SELECT recording_id, recording_id || '_' || (60 * k) || '_' || (60 * k + 60) AS chunk_id
FROM (SELECT *, unnest(range(0, 3)) AS k FROM recordings)""",
    "manifest_row_counts": f"""WITH {RECORDINGS_SQL}
SELECT recording_id, CAST(ceil(n_frames / 500) AS BIGINT) AS manifest_rows
FROM recordings WHERE n_frames > 0""",
    "detections_by_prefix": "SELECT 'chunk_' || user_id AS chunk_id, count(*) AS detections"
    " FROM events GROUP BY user_id",
    "window_probe": f"""{_PROBE_SQL},
last AS (
  SELECT recording_id, gpu_index, gpu_name, lim, longest, bps,
         max(CASE WHEN mb <= lim THEN cand END) AS best, count(*) AS n FROM tried
  GROUP BY ALL
)
SELECT recording_id, CAST(gpu_index AS BIGINT) AS gpu_index, gpu_name,
       round(coalesce(best, 5.0), 9) AS search_s, true AS rounded,
       round(least(longest, lim / (bps * 1.35::DOUBLE / 1048576)), 6) AS bound_s,
       format('GPU {{}} ({{}}) limit {{:.0f}} MiB', gpu_index, gpu_name, lim) AS notes FROM last""",
    "window_probe_attempts": f"""{_PROBE_SQL}
SELECT recording_id, attempt, round(cand, 9) AS duration_s, round(mb, 9) AS estimated_vram_mb,
       mb <= lim AS fits FROM tried""",
    "recording_headers": """
SELECT 'rec_' || item_id AS recording_id, 1 AS channels, 10 AS sample_rate,
       1 AS sample_width_bytes, CAST(44 AS BIGINT) AS data_offset,
       octet_length(encode(text)) AS n_frames, octet_length(encode(text)) / 10 AS duration_s,
       CAST(NULL AS VARCHAR) AS error FROM benchmark""",
    "window_audio": """
WITH t AS (SELECT 'rec_' || item_id AS recording_id, hex(encode(text)) AS h,
                  octet_length(encode(text)) AS n FROM benchmark),
w AS (SELECT *, unnest(range(0, n, 20)) AS s FROM t),
e AS (SELECT *, least(s + 30, n) AS f FROM w),
c AS (SELECT *, CAST(trunc(s / 10 * 1000) AS BIGINT) AS start_ms,
             CAST(trunc(f / 10 * 1000) AS BIGINT) AS end_ms FROM e)
SELECT recording_id, recording_id || '_chunk_' || start_ms || '_' || end_ms AS chunk_id,
       start_ms, end_ms,
       substr(h, CAST(s * 2 + 1 AS BIGINT), CAST((f - s) * 2 AS BIGINT)) AS samples,
       CAST(44 + f - s AS INTEGER) AS bytes, true AS hash_fits FROM c""",
    "window_audio_manifest": """
WITH t AS (SELECT 'rec_' || item_id AS recording_id, octet_length(encode(text)) AS n FROM benchmark),
w AS (SELECT *, unnest(range(0, n, 20)) AS s FROM t),
e AS (SELECT *, CAST(trunc(s / 10 * 1000) AS BIGINT) AS start_ms,
             CAST(trunc(least(s + 30, n) / 10 * 1000) AS BIGINT) AS end_ms FROM w),
c AS (SELECT *, recording_id || '_chunk_' || start_ms || '_' || end_ms AS chunk_id FROM e)
SELECT recording_id, chunk_id, '/chunks/' || recording_id || '/' || chunk_id || '.wav' AS source_path,
       start_ms, end_ms, CAST(1000 AS BIGINT) AS overlap_ms, CAST(64 AS INTEGER) AS hash_length FROM c""",
}
