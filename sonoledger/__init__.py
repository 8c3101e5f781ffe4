"""Time-stamped detections on Spark: cut, score, collect, report."""

from sonoledger.operators.bundle import load_views, verify_report_database, write_bundle
from sonoledger.operators.ingest import ingest, read_detections
from sonoledger.operators.reports import database_report, quicklook, summarize, table_report
from sonoledger.operators.score import ScoreOptions, command_detector, score_windows
from sonoledger.session import build_session

__all__ = [
    "ScoreOptions",
    "build_session",
    "command_detector",
    "database_report",
    "ingest",
    "load_views",
    "quicklook",
    "read_detections",
    "score_windows",
    "summarize",
    "table_report",
    "verify_report_database",
    "write_bundle",
]
