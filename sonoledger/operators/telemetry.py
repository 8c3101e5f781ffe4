"""Summaries of scoring events and run outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.functions.device_metrics import (
    attempt_number,
    device_key,
    event_attempt,
    event_retries,
    metric_block,
)
from sonoledger.functions.scalars import blank_to_null

# Fixed values.
HISTORY_LENGTH = 24
TAIL_PLAIN, TAIL_MONITOR = 10, 15
HOTSPOT_ROWS = 5
NO_VALUE = "-"


def log_order() -> Column:
    """Line order of one log."""

    return F.col("event_order")


def time_order() -> Column:
    """Event time first, for logs rolled over many files."""

    return F.struct("timestamp", "event_order")


def device_events(events: DataFrame, order: Column | None = None) -> DataFrame:
    """Per event: device key, outcome flags, retries and measurements."""

    metrics = metric_block()
    measured = F.coalesce(*[
        metrics[name].cast("double")
        for name in ("index", "utilization", "memory_used_mb", "memory_total_mb")
    ]).isNotNull()
    status = F.lower("status")
    return events.select(
        device_key().alias("device"),
        (order if order is not None else log_order()).alias("ord"),
        "gpu_name",
        "status",
        "chunk_id",
        "timestamp",
        "runtime_s",
        (status == "success").alias("is_success"),
        (status == "failure").alias("is_failure"),
        event_attempt().alias("attempt"),
        event_retries().alias("retries"),
        F.when(measured, metrics).alias("metrics"),
        metrics["utilization"].alias("utilization"),
        metrics["memory_used_mb"].alias("memory_used_mb"),
        metrics["memory_total_mb"].alias("memory_total_mb"),
    )


def device_totals(flat: DataFrame) -> DataFrame:
    """Counts, means, extremes and last-seen values per device.

    Devices are few and any of them may hold most events; every function here
    combines inside the tasks, so the shuffle carries one row per device and task.
    """

    def last_where(value: Column | str, keep: Column) -> Column:
        return F.max_by(value, F.when(keep, F.col("ord")))

    retried = F.col("is_success") & (F.col("retries") > 0)
    return (
        flat.groupBy("device")
        .agg(
            last_where("gpu_name", blank_to_null("gpu_name").isNotNull()).alias("name"),
            F.count("*").alias("events"),
            F.count_if("is_success").alias("success"),
            F.count_if("is_failure").alias("failures"),
            F.coalesce(F.sum(F.when(retried, F.col("retries"))), F.lit(0)).alias("retry_attempts"),
            F.count_if(retried).alias("retry_events"),
            F.coalesce(F.sum(F.when(F.col("is_failure"), F.col("attempt"))), F.lit(0)).alias(
                "failure_attempts"
            ),
            F.avg("runtime_s").alias("avg_runtime"),
            F.min("utilization").alias("util_min"),
            F.avg("utilization").alias("util_avg"),
            F.max("utilization").alias("util_max"),
            F.max("memory_used_mb").alias("max_memory"),
            last_where(
                F.col("memory_total_mb").cast("bigint"), F.col("memory_total_mb").isNotNull()
            ).alias("memory_total"),
            F.max_by("status", "ord").alias("last_status"),
            F.max_by("chunk_id", "ord").alias("last_chunk"),
            F.coalesce(
                last_where("timestamp", blank_to_null("timestamp").isNotNull()), F.lit(NO_VALUE)
            ).alias("last_timestamp"),
            last_where("metrics", F.col("metrics").isNotNull()).alias("last_metrics"),
        )
        .withColumn("name", F.coalesce("name", "device"))
    )


def history_rows(flat: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """The newest ``length`` samples per device and series, in long form.

    Only events that carry a measurement count for its series. The rank filter
    is pushed below the shuffle by the optimiser, so each task sends at most
    ``length`` rows per device and series, however many events a device has.
    """

    series = flat.select(
        "device",
        "ord",
        F.explode(
            F.array(
                F.struct(F.lit("utilization").alias("series"), F.col("utilization").alias("v")),
                F.struct(F.lit("memory").alias("series"), F.col("memory_used_mb").alias("v")),
                F.struct(
                    F.lit("retries").alias("series"), F.col("retries").cast("double").alias("v")
                ),
            )
        ).alias("sample"),
    ).select("device", "ord", "sample.series", F.col("sample.v").alias("value"))
    return newest_samples(series.filter(F.col("value").isNotNull()), length)


def newest_samples(series: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """Rank samples per device and series from the newest (``age`` 1) and keep ``length``."""

    newest = Window.partitionBy("device", "series").orderBy(F.desc("ord"))
    return series.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= length)


def device_histories(flat: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """One array per series and device, oldest sample first (at most ``length``)."""

    return pack_histories(history_rows(flat, length))


def pack_histories(samples: DataFrame) -> DataFrame:
    """Arrays per device from ranked samples; their number per device is fixed."""

    def series(name: str) -> Column:
        picked = F.collect_list(
            F.when(F.col("series") == name, F.struct((-F.col("age")).alias("k"), "value"))
        )
        return F.transform(F.array_sort(picked), lambda p: p["value"])

    return samples.groupBy("device").agg(
        series("utilization").alias("util_history"),
        series("memory").alias("memory_history"),
        series("retries").alias("retry_history"),
    )


def device_summary(
    events: DataFrame, order: Column | None = None, length: int = HISTORY_LENGTH
) -> DataFrame:
    """The monitor table: totals and short histories per device."""

    flat = device_events(events, order)
    return device_totals(flat).join(device_histories(flat, length), "device", "left")


def tail_events(
    events: DataFrame, n: int = TAIL_MONITOR, order: Column | None = None
) -> DataFrame:
    """The last ``n`` events, oldest first."""

    ord_ = order if order is not None else log_order()
    return (
        events.withColumn("_ord", ord_).orderBy(F.desc("_ord")).limit(n).orderBy("_ord").drop("_ord")
    )


def tail_table(events: DataFrame, n: int = TAIL_MONITOR) -> DataFrame:
    """Columns of the live tail."""

    device = F.coalesce(F.col("gpu_index").cast("string"), F.lit("CPU"))
    return tail_events(events, n).select(
        "timestamp",
        "status",
        "chunk_id",
        device.alias("device"),
        "runtime_s",
        attempt_number().alias("attempt"),
        metric_block().alias("metrics"),
    )


def worker_totals(results: DataFrame) -> DataFrame:
    """Jobs, outcomes and retries per worker."""

    ok = F.col("status") == "success"
    failed_tries = F.greatest(F.coalesce("attempts", F.lit(1)) - 1, F.lit(0))
    return results.groupBy("worker").agg(
        F.count("*").alias("jobs"),
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failure"),
        F.sum(F.when(ok, F.coalesce("retries", F.lit(0))).otherwise(0)).alias("retries"),
        F.sum(F.when(ok, F.lit(0)).otherwise(failed_tries)).alias("failed_retries"),
    )


def retry_hotspots(results: DataFrame) -> DataFrame:
    """Windows that failed or needed retries."""

    return results.filter(
        ~F.coalesce(F.col("status") == "success", F.lit(False))
        | (F.coalesce("retries", F.lit(0)) > 0)
    )


def top_hotspots(results: DataFrame, n: int = HOTSPOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """The worst ``n`` windows, and one row counting all and the ones not shown."""

    hot = retry_hotspots(results)
    top = hot.orderBy(
        F.desc(F.coalesce("retries", F.lit(0))), "chunk_id", F.asc_nulls_first("recording_id")
    ).limit(n)
    counts = hot.agg(
        F.count("*").alias("hotspots"),
        F.greatest(F.count("*") - F.lit(n), F.lit(0)).alias("not_shown"),
    )
    return top, counts
