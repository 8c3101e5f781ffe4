"""Incremental ingest of payload files, and buckets over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sonoledger.operators.ingest import enrich_payloads, explode_detections
from sonoledger.operators.score import even_partitions
from sonoledger.session import materialise
from sonoledger.sources._scan import LISTING_TASKS, listing_tasks, scan_path, set_for
from sonoledger.sources.manifests import manifest_index, read_manifest
from sonoledger.sources.payloads import parse_payloads
from sonoledger.streaming.compact import read_batches

_SUM_KEYS = ["bucket", "chunk_id", "chunk_start_ms"]
# Rows that a task adds up: windows are many, so it may hold a sum for each.
ROWS_PER_TASK = 500_000
# Names of waiting files that a stream keeps; the checkpoint holds those it has read anyway.
WAITING_FILES = 1_000_000


def payload_stream(
    spark: SparkSession, root: str, max_files: int | None = None
) -> DataFrame:
    """New ``*.json`` payload files below ``root`` as ``(file_path, value)``.

    Files that wait are remembered, so a backlog is not listed anew every few batches. Set
    ``LISTING_TASKS`` in a session that streams many small files: each batch lists its own.
    """

    reader = spark.readStream.option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.json"
    ).option("maxCachedFiles", WAITING_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with set_for(spark, LISTING_TASKS, listing_tasks(spark)):
        files = reader.text(root, wholetext=True)
    return files.select(scan_path().alias("file_path"), F.col("value"))


def start_ingest(
    files: DataFrame,
    out: str,
    checkpoint: str,
    manifest: DataFrame | str | None = None,
    dataset_roots: DataFrame | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Append the detections of new payload files to a Parquet table.

    A manifest given as a path is read anew for a micro-batch when its files have changed,
    so windows planned after the start are known; one given as a table is fixed at the start.
    A batch is joined with the manifest's rows of its own windows only.

    The checkpoint remembers which files were read, and each micro-batch owns one
    folder of the table that a repeated run overwrites: every file's rows appear
    exactly once. This also packs many small payload files into few large ones.
    :func:`compact.read_batches` reads the table, :func:`compact.compact` folds its
    batches into large files.
    """

    # A fixed table is reduced once at the start rather than in every micro-batch.
    fixed = materialise(manifest_index(manifest), "manifest") if isinstance(manifest, DataFrame) else None
    held: dict[str, object] = {}

    def index_of(spark: SparkSession) -> DataFrame | None:
        if not isinstance(manifest, str):
            return fixed
        state = _files_of(spark, manifest)
        if held.get("state") != state:
            held.update(state=state, index=materialise(manifest_index(read_manifest(spark, manifest)), "manifest"))
        return held["index"]

    def step(batch: DataFrame, batch_id: int) -> None:
        index, payloads = index_of(batch.sparkSession), parse_payloads(batch)
        if index is not None:
            payloads = payloads.persist()
            index = index.join(payloads.select("chunk_id"), "chunk_id", "left_semi")
        rows = explode_detections(enrich_payloads(payloads, index, dataset_roots))
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")
        if index is not None:
            payloads.unpersist()

    return _start(files, step, checkpoint, interval)


def _files_of(spark: SparkSession, path: str) -> tuple:
    """What tells one state of some files from another, without reading them."""

    with set_for(spark, LISTING_TASKS, listing_tasks(spark)):
        files = spark.read.format("binaryFile").load(path)
    mark = F.xxhash64("path", "modificationTime", "length")
    return tuple(files.agg(F.count("*"), F.bit_xor(mark), F.max("modificationTime")).first())


def _start(
    rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None
) -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    writer = (
        writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    )
    return writer.start()


def start_timeline(
    detections: DataFrame,
    out: str,
    checkpoint: str,
    event_time: str = "event_time",
    bucket_minutes: int = 60,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the bucket timeline of a detection stream as sums, without a watermark.

    Each micro-batch writes one row per bucket and window it saw to a folder of its own,
    which a repeated run overwrites. No row is too late, and the newest bucket is there at
    once: :func:`read_timeline` adds the sums up.
    """

    width = f"{max(1, bucket_minutes)} minutes"

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.window(event_time, width).alias("bucket"), "chunk_id", "chunk_start_ms", "confidence")
        sums = by_window(rows).groupBy(*_SUM_KEYS).agg(
            F.count("*").alias("n"), F.sum("confidence").alias("total"), F.count("confidence").alias("known")
        )
        sums.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    return _start(detections, step, checkpoint, interval)


def by_window(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows of a bucket and window in one task, tasks of bounded length.

    Dealt before they are added up: adding up first, in tasks cut by bytes, holds as many
    sums as a file of well-packed rows has windows.
    """

    return rows.repartition(max(1, even_partitions(rows, per_task)), *_SUM_KEYS)


def add_up(sums: DataFrame) -> DataFrame:
    """Sums of a timeline, one row per bucket and window; also a fold for :func:`compact.compact`."""

    return by_window(sums).groupBy(*_SUM_KEYS).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("known").alias("known")
    )


def read_timeline(spark: SparkSession, out: str) -> DataFrame:
    """The timeline so far: per bucket, its detections and the mean of its windows' means."""

    per_window = add_up(read_batches(spark, out)).withColumn("mean", F.try_divide("total", "known"))
    return per_window.groupBy("bucket").agg(
        F.sum("n").alias("detections"), F.avg("mean").alias("avg_confidence")
    ).select(
        F.col("bucket.start").alias("bucket_start"), F.col("bucket.end").alias("bucket_end"),
        "detections", "avg_confidence",
    )


def windowed_timeline(
    detections: DataFrame,
    event_time: str = "event_time",
    bucket_minutes: int = 60,
    lateness: str = "10 minutes",
) -> DataFrame:
    """The bucket timeline of a detection stream over wall-clock time.

    Two chained aggregations as in the batch form: per recording window and
    bucket, then per bucket. For sinks that need final rows: rows later than the
    watermark are dropped, and a bucket is emitted once the watermark has passed it.
    :func:`start_timeline` loses no row.
    """

    width = f"{max(1, bucket_minutes)} minutes"
    per_window = (
        detections.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, width).alias("bucket"), "chunk_id", "chunk_start_ms")
        .agg(F.count("*").alias("n"), F.avg("confidence").alias("mean"))
    )
    return (
        per_window.groupBy(F.window(F.window_time("bucket"), width).alias("bucket"))
        .agg(F.sum("n").alias("detections"), F.avg("mean").alias("avg_confidence"))
        .select("bucket.start", "bucket.end", "detections", "avg_confidence")
        .withColumnsRenamed({"start": "bucket_start", "end": "bucket_end"})
    )
