"""Telemetry event logs: JSON lines, batch or streaming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.schemas import TELEMETRY_LINE, TELEMETRY_LOG
from sonoledger.sources._scan import file_order, line_order, nothing_there

DEFAULT_STATUS = "unknown"


def read_telemetry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events in log order (``event_order``); a missing log is an empty table."""

    try:
        lines = spark.read.text(path)
    except AnalysisException as exc:
        if nothing_there(exc):
            return spark.createDataFrame([], TELEMETRY_LOG)
        raise
    return parse_telemetry(lines)


def parse_telemetry(lines: DataFrame) -> DataFrame:
    """Typed events from a text scan (batch or ``readStream``); blank lines are skipped.

    ``details`` holds the fields the reports know, ``details_json`` all keys as JSON text
    (a text that is no object as it is; NULL without details). Broken lines and events
    without a chunk are left out (see :func:`count_skipped`).

    Spark does not number the rows of a stream, so there ``event_order`` stops
    at the file; order those by time first.
    """

    order = file_order() if lines.isStreaming else line_order()
    return (
        lines.filter(F.trim("value") != "")
        .select(
            _event().alias("event"), order.alias("event_order"),
            F.get_json_object("value", "$.details").alias("details_json"),
        )
        .select("event.*", "event_order", "details_json")
        .filter(F.col("chunk_id").isNotNull())
        .withColumns(
            {
                "status": F.coalesce("status", F.lit(DEFAULT_STATUS)),
                "timestamp": F.coalesce("timestamp", F.lit("")),
            }
        )
    )


def _event() -> Column:
    return F.from_json("value", TELEMETRY_LINE.simpleString())


def count_skipped(lines: DataFrame) -> DataFrame:
    """One row: lines of a text scan that aren't blank, and those of them that are no event.

    ``broken`` lines are no JSON, the others that are skipped have no ``chunk_id``.
    """

    skipped, json = F.col("skipped"), F.col("json")
    return (
        lines.filter(F.trim("value") != "")
        .select(_event()["chunk_id"].isNull().alias("skipped"), F.try_parse_json("value").isNotNull().alias("json"))
        .agg(
            F.count("*").alias("lines"),
            F.count_if(skipped & ~json).alias("broken"),
            F.count_if(skipped & json).alias("without_chunk_id"),
        )
    )


def append_telemetry(events: DataFrame, path: str) -> str:
    """Add events as new JSON-lines files, which a streaming reader picks up.

    Where there is a ``details_json``, it is written as the details, with all its keys.
    """

    columns = [f.name for f in TELEMETRY_LINE if f.name in events.columns]
    if "details_json" in events.columns:
        typed = F.to_json("details") if "details" in columns else F.lit(None).cast("string")
        whole = F.coalesce("details_json", typed)
        columns = [c for c in columns if c != "details"]
        details = F.coalesce(F.try_parse_json(whole), whole.cast("variant"))
        events = events.select(*columns, details.alias("details"))
        columns.append("details")
    events.select(*columns).write.mode("append").json(path)
    return path
