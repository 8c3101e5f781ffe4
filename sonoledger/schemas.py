"""Fixed column lists of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _BINARY = T.DoubleType(), T.BinaryType()


def _table(*groups: tuple[T.DataType, list[str]]) -> T.StructType:
    """A struct from ``(type, names)`` groups, in order."""

    return T.StructType([T.StructField(name, kind) for kind, names in groups for name in names])


DETECTIONS = _table(
    (_STRING, ["recording_id", "chunk_id"]),
    (_LONG, ["chunk_start_ms", "chunk_end_ms", "timestamp_ms", "absolute_time_ms", "end_ms", "absolute_end_ms"]),
    (_STRING, ["label", "label_code", "label_name"]),
    (_DOUBLE, ["confidence"]),
    (_STRING, ["status", "runner", "model_version", "chunk_sha256", "source_path", "dataset_root"]),
)

MANIFEST = _table(
    (_STRING, ["recording_id", "chunk_id", "source_path"]),
    (_LONG, ["start_ms", "end_ms", "overlap_ms"]),
    (_STRING, ["sha256", "notes"]),
)

RAW_LABELS = _table(
    (_STRING, ["label_dir", "file_name"]),
    (_LONG, ["timestamp_ms", "end_ms"]),
    (_STRING, ["label", "label_code", "label_name"]),
    (_DOUBLE, ["confidence"]),
)

DEVICE_METRICS = _table((_LONG, ["index"]), (_DOUBLE, ["utilization", "memory_used_mb", "memory_total_mb"]))

EVENT_DETAILS = T.StructType(
    [
        *_table(
            (_DOUBLE, ["attempt"]),
            (_STRING, ["output", "runner", "stdout", "stderr"]),
            (_LONG, ["returncode"]),
            (_DOUBLE, ["backoff_s"]),
        ),
        T.StructField(
            "gpu_metrics", _table((DEVICE_METRICS, ["before", "after"]))
        ),
    ]
)

TELEMETRY_LINE = _table(
    (_STRING, ["chunk_id"]),
    (_LONG, ["gpu_index"]),
    (_STRING, ["gpu_name", "status", "timestamp", "finished_at"]),
    (_DOUBLE, ["runtime_s"]),
    (EVENT_DETAILS, ["details"]),
)

# One event row: the parsed line plus its place in the log.
TELEMETRY = T.StructType(
    [
        *TELEMETRY_LINE,
        T.StructField("event_order", _table((_STRING, ["file"]), (_LONG, ["block", "row"]))),
    ]
)

# A row of a log: beside the typed fields of ``details``, the whole object as JSON text.
TELEMETRY_LOG = T.StructType([*TELEMETRY, T.StructField("details_json", _STRING)])

JOB_RESULTS = _table(
    (_STRING, ["chunk_id", "recording_id", "status"]),
    (_INT, ["attempts", "retries"]),
    (_STRING, ["output", "worker"]),
    (_DOUBLE, ["last_backoff_s"]),
    (_STRING, ["last_error", "error"]),
)

CHUNK_STATUS = _table(
    (_STRING, ["recording_id", "audio_path", "chunk_output_dir", "manifest_path"]),
    (_DOUBLE, ["chunk_duration", "overlap"]),
    (_STRING, ["updated_at", "status", "started_at", "completed_at"]),
    (_LONG, ["manifest_rows"]),
    (_DOUBLE, ["duration_s"]),
    (_STRING, ["error"]),
)

CHUNK_PLAN = _table(
    (_STRING, ["recording_id", "audio_path", "manifest_path", "chunk_output_dir"]),
    (_DOUBLE, ["chunk_duration", "overlap"]),
)

RECORDINGS = _table(
    (_STRING, ["recording_id", "audio_path"]),
    (_LONG, ["length"]),
    (_INT, ["channels", "sample_rate", "sample_width_bytes"]),
    (_LONG, ["data_offset", "n_frames"]),
    (_DOUBLE, ["duration_s"]),
    (_STRING, ["error"]),
)

CHUNK_BLOBS = _table(
    (_STRING, ["recording_id", "chunk_id", "source_path", "audio_path"]),
    (_LONG, ["start_ms", "end_ms", "overlap_ms"]),
    (_BINARY, ["content"]),
    (_STRING, ["error"]),
)

PROBE_ATTEMPTS = (
    "ARRAY<STRUCT<attempt: INT, duration_s: DOUBLE, estimated_vram_mb: DOUBLE,"
    " fits: BOOLEAN, reason: STRING>>"
)
