"""Fields derived from the details of one telemetry event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def metric_block(details: str = "details") -> Column:
    """The measurement taken after the work, else the one taken before it."""

    return F.coalesce(
        F.col(f"{details}.gpu_metrics.after"), F.col(f"{details}.gpu_metrics.before")
    )


def attempt_number(details: str = "details") -> Column:
    """Numeric attempt counter, truncated; NULL when absent or not a number."""

    return F.col(f"{details}.attempt").try_cast("int")


def event_attempt(details: str = "details") -> Column:
    """Attempt counter as counted in summaries: never below one."""

    return F.greatest(F.coalesce(attempt_number(details), F.lit(1)), F.lit(1))


def event_retries(details: str = "details") -> Column:
    return event_attempt(details) - F.lit(1)


def device_key(gpu_index: str = "gpu_index") -> Column:
    index = F.col(gpu_index)
    return F.when(index.isNotNull(), F.concat(F.lit("GPU "), index.cast("string"))).otherwise(
        F.lit("CPU")
    )
