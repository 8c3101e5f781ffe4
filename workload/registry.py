"""All registered queries and their SQL."""

from __future__ import annotations

from workload import field, ingest, planning, reports, telemetry, windows

_AREAS = [reports, ingest, windows, telemetry, planning, field]

QUERIES = {name: query for area in _AREAS for name, query in area.QUERIES.items()}
ORACLE = {name: sql for area in _AREAS for name, sql in area.ORACLE.items()}
