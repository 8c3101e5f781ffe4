"""Small exports: report tables, summaries and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report_csv(report: DataFrame, path: str) -> str:
    """A report table as CSV, in the order it was sorted in."""

    report.write.mode("overwrite").csv(path, header=True, nullValue="", escape='"')
    return path


def write_summary_json(summary: DataFrame, path: str) -> str:
    summary.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def write_plan(plan: DataFrame, path: str, fmt: str = "csv") -> str:
    """A plan as CSV or JSON lines; the reader of saved plans takes both.

    Columns that only served the selection are left out. CSV has no lists, so
    there they are written as JSON text.
    """

    rows = plan.drop("status", "has_manifest")
    if fmt == "json":
        rows.write.mode("overwrite").json(path, ignoreNullFields=False)
        return path
    lists = [f.name for f in rows.schema if f.dataType.typeName() == "array"]
    rows = rows.withColumns({name: F.to_json(name) for name in lists}) if lists else rows
    rows.write.mode("overwrite").csv(path, header=True, nullValue="", escape='"')
    return path
