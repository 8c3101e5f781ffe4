"""Live views of the telemetry log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sonoledger.operators import telemetry as tel
from sonoledger.sources._scan import nothing_there
from sonoledger.sources.telemetry import parse_telemetry


def telemetry_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """New log files as they arrive.

    A file is read once: writers must add files (see ``append_telemetry``), as
    lines added to a file already seen are not picked up.
    """

    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_telemetry(reader.text(path))


def live_totals(events: DataFrame) -> DataFrame:
    """Running totals per device; state is one row per device."""

    return tel.device_totals(tel.device_events(events, tel.time_order()))


def start_totals(
    events: DataFrame, on_update: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Call ``on_update`` with the complete table after every micro-batch."""

    writer = (
        live_totals(events)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_update)
    )
    return _trigger(writer, interval).start()


def _trigger(writer, interval: str | None):
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)


def keep_newest(
    stream: DataFrame,
    state_dir: str,
    shape: Callable[[DataFrame], DataFrame],
    reduce: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Fold micro-batches into a small table: newest = reduce(previous + shape(batch)).

    ``reduce`` is a top-n with a fixed n per group, so what is carried over stays
    small and each batch is thinned inside its tasks, also when one device sends
    nearly all events. Two folders take turns: a batch reads the one before it
    and replaces the one before that, so a batch run again after a failure finds
    its predecessor untouched. The folder belongs to one checkpoint.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        fresh = shape(batch)
        before = _read_slot(batch.sparkSession, state_dir, batch_id - 1)
        rows = fresh if before is None else fresh.unionByName(before)
        kept = reduce(rows).withColumn("batch_id", F.lit(batch_id))
        kept.write.mode("overwrite").parquet(_slot(state_dir, batch_id))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return _trigger(writer, interval).start()


def _slot(state_dir: str, batch_id: int) -> str:
    return f"{state_dir.rstrip('/')}/slot={batch_id % 2}"


def _read_slot(spark: SparkSession, state_dir: str, batch_id: int) -> DataFrame | None:
    if batch_id < 0:
        return None
    try:
        kept = spark.read.parquet(_slot(state_dir, batch_id))
    except AnalysisException as exc:
        if nothing_there(exc):
            return None
        raise
    return kept.filter(F.col("batch_id") == batch_id).drop("batch_id")


def read_newest(spark: SparkSession, state_dir: str) -> DataFrame:
    """The latest state of a table kept by :func:`keep_newest`."""

    slots = spark.read.parquet(state_dir)
    newest = slots.agg(F.max("batch_id").alias("batch_id"))
    return slots.join(newest, "batch_id", "left_semi").drop("batch_id", "slot")


_LONG = ["device", "series", "ord", "value"]


def start_histories(
    events: DataFrame, state_dir: str, checkpoint: str, length: int = tel.HISTORY_LENGTH,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the newest ``length`` samples per device and series across batches."""

    def shape(batch: DataFrame) -> DataFrame:
        return tel.history_rows(tel.device_events(batch, tel.time_order()), length).select(*_LONG)

    def reduce(rows: DataFrame) -> DataFrame:
        return tel.newest_samples(rows, length).select(*_LONG)

    return keep_newest(events, state_dir, shape, reduce, checkpoint, interval)


def read_histories(
    spark: SparkSession, state_dir: str, length: int = tel.HISTORY_LENGTH
) -> DataFrame:
    """Arrays per device from the kept samples."""

    return tel.pack_histories(tel.newest_samples(read_newest(spark, state_dir), length))


def start_tail(
    events: DataFrame, state_dir: str, checkpoint: str, n: int = tel.TAIL_MONITOR,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the last ``n`` events across batches."""

    def reduce(rows: DataFrame) -> DataFrame:
        return tel.tail_events(rows, n, tel.time_order())

    return keep_newest(events, state_dir, reduce, reduce, checkpoint, interval)
