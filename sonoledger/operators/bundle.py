"""Stored reports: the table with its views, and the folder of exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.scalars import MS_PER_MINUTE, bucket_minutes_floor
from sonoledger.operators import reports as R
from sonoledger.session import materialise
from sonoledger.sources.tables import write_report_csv, write_summary_json

# Object names of a stored report.
TABLE = "detections"
VIEWS = ("label_summary", "recording_summary", "timeline_summary")


def build_report_database(
    detections: DataFrame, database: str, bucket_minutes: int = R.DEFAULT_BUCKET_MINUTES
) -> str:
    """Save the detections as a catalog table and define the three summary views.

    The bucket width is part of the timeline view. Views hold no order: readers
    sort (see :func:`load_views`), which saves every other query the sort.
    """

    spark = detections.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    table = f"`{database}`.`{TABLE}`"
    detections.write.mode("overwrite").saveAsTable(table)
    width = bucket_minutes_floor(bucket_minutes) * MS_PER_MINUTE
    spark.sql(
        f"""CREATE OR REPLACE VIEW `{database}`.label_summary AS
        SELECT label, coalesce(raw_name, '') AS label_name, detections, avg_confidence
        FROM (SELECT label, label_name AS raw_name, count(*) AS detections,
                     avg(confidence) AS avg_confidence
              FROM {table} GROUP BY label, label_name)"""
    )
    spark.sql(
        f"""CREATE OR REPLACE VIEW `{database}`.recording_summary AS
        SELECT recording_id, count(*) AS detections, avg(confidence) AS avg_confidence
        FROM {table} GROUP BY recording_id"""
    )
    spark.sql(
        f"""CREATE OR REPLACE VIEW `{database}`.timeline_summary AS
        SELECT cast(floor(start_ms / {width}) AS BIGINT) AS bucket_index,
               min(start_ms) AS bucket_start_ms, sum(n) AS detections, avg(c) AS avg_confidence
        FROM (SELECT coalesce(chunk_start_ms, 0) AS start_ms, n, c
              FROM (SELECT chunk_id, chunk_start_ms, count(*) AS n, avg(confidence) AS c
                    FROM {table} GROUP BY chunk_id, chunk_start_ms))
        GROUP BY cast(floor(start_ms / {width}) AS BIGINT)"""
    )
    return database


def missing_objects(spark: SparkSession, database: str) -> list[str]:
    return [
        name
        for name in (TABLE, *VIEWS)
        if not spark.catalog.tableExists(f"`{database}`.`{name}`")
    ]


def verify_report_database(spark: SparkSession, database: str) -> None:
    """Raise if the database, its table or one of its views is not there."""

    if not spark.catalog.databaseExists(database):
        raise FileNotFoundError(f"no database {database}")
    missing = missing_objects(spark, database)
    if missing:
        raise RuntimeError(f"{database} is incomplete, missing: {', '.join(missing)}")


@dataclass(frozen=True)
class SummaryViews:
    label_summary: DataFrame
    recording_summary: DataFrame
    timeline_summary: DataFrame


def load_views(
    spark: SparkSession,
    database: str,
    limit_labels: int | None = None,
    limit_recordings: int | None = None,
) -> SummaryViews:
    """The stored views, sorted and optionally cut to the top rows."""

    verify_report_database(spark, database)

    def ranked(view: str, limit: int | None, *ties: str) -> DataFrame:
        rows = spark.table(f"`{database}`.`{view}`").orderBy(
            F.desc("detections"), *[F.asc_nulls_first(t) for t in ties]
        )
        return rows.limit(max(1, limit)) if limit else rows

    return SummaryViews(
        ranked("label_summary", limit_labels, "label", "label_name"),
        ranked("recording_summary", limit_recordings, "recording_id"),
        spark.table(f"`{database}`.timeline_summary").orderBy("bucket_start_ms", "bucket_index"),
    )


@dataclass(frozen=True)
class BundleOptions:
    bucket_minutes: int = R.DEFAULT_BUCKET_MINUTES
    table_labels: int = R.TABLE_LABELS
    table_recordings: int = R.TABLE_RECORDINGS
    quicklook_labels: int = R.QUICKLOOK_LABELS
    quicklook_recordings: int = R.QUICKLOOK_RECORDINGS
    database_labels: int = R.DATABASE_LABELS
    database_recordings: int = R.DATABASE_RECORDINGS
    quicklook: bool = True
    table: bool = True
    database: bool = True


def write_bundle(
    detections: DataFrame,
    base_dir: str,
    prefix: str,
    options: BundleOptions = BundleOptions(),
    database: str | None = None,
    rolled: DataFrame | None = None,
) -> dict[str, str]:
    """All report exports below ``base_dir``, named after ``prefix``.

    The detections are read once, into the per-window rollup (or ``rolled``, if
    that is at hand); every table of the bundle comes from that.
    """

    base = base_dir.rstrip("/")
    rolled = materialise(R.rollup(detections), "rollup") if rolled is None else rolled
    written: dict[str, str] = {}
    if options.quicklook:
        folder = f"{base}/{prefix}_quicklook"
        ql = R.quicklook(rolled, options.quicklook_labels, options.quicklook_recordings)
        write_report_csv(ql.top_labels, f"{folder}/labels.csv")
        write_report_csv(ql.top_recordings, f"{folder}/recordings.csv")
        write_report_csv(ql.chunk_timeline, f"{folder}/chunks.csv")
        written["quicklook"] = folder
    if options.table:
        folder = f"{base}/{prefix}_parquet_report"
        tr = R.table_report(
            rolled, options.table_labels, options.table_recordings, options.bucket_minutes
        )
        write_report_csv(tr.labels, f"{folder}/labels.csv")
        write_report_csv(tr.recordings, f"{folder}/recordings.csv")
        write_report_csv(tr.timeline, f"{folder}/timeline.csv")
        write_summary_json(tr.summary, f"{folder}/summary.json")
        written["table"] = folder
    if options.database:
        folder = f"{base}/{prefix}_database_exports"
        name = database or _catalog_name(prefix)
        build_report_database(detections, name, options.bucket_minutes)
        dr = R.database_report(
            rolled, options.database_labels, options.database_recordings, options.bucket_minutes
        )
        write_report_csv(dr.labels, f"{folder}/label_summary.csv")
        write_report_csv(dr.recordings, f"{folder}/recording_summary.csv")
        write_report_csv(dr.timeline, f"{folder}/timeline.csv")
        written["database"], written["database_exports"] = name, folder
    return written


def _catalog_name(prefix: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in prefix).lower()


# ---- the same reports for every recording at once -------------------------------------


def write_recording_reports(
    detections: DataFrame, base_dir: str, options: BundleOptions = BundleOptions()
) -> dict[str, str]:
    """The per-recording tables as Parquet, one table for all recordings each."""

    written = {}
    for name, table in per_recording_reports(detections, options).items():
        written[name] = f"{base_dir.rstrip('/')}/{name}.parquet"
        table.write.mode("overwrite").parquet(written[name])
    return written


def per_recording_reports(
    detections: DataFrame, options: BundleOptions = BundleOptions()
) -> dict[str, DataFrame]:
    """Bundle tables of all recordings in one pass, keyed by ``recording_id``.

    Replaces a loop over recordings. Top-k per recording is a rank filter that
    already thins rows before the shuffle.
    """

    from pyspark.sql import Window

    rolled = detections if R.is_rolled(detections) else R.rollup(detections)
    mean = F.try_divide(F.sum("confidence_sum"), F.sum("confidence_count"))
    labels = rolled.groupBy("recording_id", "label", "label_name").agg(
        F.sum(R.ROLLED).alias("detections"), mean.alias("avg_confidence")
    )
    rank = Window.partitionBy("recording_id").orderBy(
        F.desc("detections"), F.asc_nulls_first("label"), F.asc_nulls_first("label_name")
    )
    windows = rolled.groupBy("recording_id", "chunk_id", "chunk_start_ms").agg(
        F.sum(R.ROLLED).alias("detections"), mean.alias("avg_confidence")
    )
    width = bucket_minutes_floor(options.bucket_minutes) * MS_PER_MINUTE
    start = F.coalesce("chunk_start_ms", F.lit(0))
    return {
        "labels": labels.withColumn("rank", F.row_number().over(rank)).filter(
            F.col("rank") <= options.table_labels
        ),
        "chunks": windows,
        "timeline": windows.groupBy(
            "recording_id", F.floor(start / F.lit(width)).cast("bigint").alias("bucket_index")
        ).agg(
            F.min(start).alias("bucket_start_ms"),
            F.sum("detections").alias("detections"),
            F.avg("avg_confidence").alias("avg_confidence"),
        ),
    }
