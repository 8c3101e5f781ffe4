"""Typed readers and writers."""

from sonoledger.sources.detections import (
    read_detection_folder,
    read_detection_table,
    write_detections,
    write_detections_csv,
)
from sonoledger.sources.labels import list_label_dirs, read_raw_labels
from sonoledger.sources.manifests import (
    manifest_index,
    read_manifest,
    read_plan_manifests,
    write_manifest,
)
from sonoledger.sources.payloads import count_unreadable, parse_payloads, read_payloads
from sonoledger.sources.recordings import discover_recordings, read_wav_headers
from sonoledger.sources.runs import (
    read_job_results,
    read_run_summary,
    write_job_results,
    write_worker_totals,
)
from sonoledger.sources.status import append_status, latest_status, read_status
from sonoledger.sources.tables import write_plan, write_report_csv, write_summary_json
from sonoledger.sources.telemetry import append_telemetry, count_skipped, parse_telemetry, read_telemetry

__all__ = [
    "append_status",
    "append_telemetry",
    "count_skipped",
    "count_unreadable",
    "discover_recordings",
    "latest_status",
    "list_label_dirs",
    "manifest_index",
    "parse_payloads",
    "parse_telemetry",
    "read_detection_folder",
    "read_detection_table",
    "read_job_results",
    "read_manifest",
    "read_payloads",
    "read_plan_manifests",
    "read_raw_labels",
    "read_run_summary",
    "read_status",
    "read_telemetry",
    "read_wav_headers",
    "write_detections",
    "write_detections_csv",
    "write_job_results",
    "write_manifest",
    "write_plan",
    "write_report_csv",
    "write_summary_json",
    "write_worker_totals",
]
