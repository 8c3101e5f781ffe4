"""Report family over the detections proxy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.operators import reports as R
from sonoledger.operators.bundle import build_report_database, load_views, per_recording_reports
from sonoledger.session import materialise, shared_dir
from sonoledger.sources.detections import (
    exclude_placeholders,
    read_detection_folder,
    read_detection_table,
    write_detections,
    write_detections_csv,
)
from sonoledger.sources.tables import write_report_csv, write_summary_json
from workload.proxies import DETECTIONS_SQL, detections

DIGITS = 9


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_confidence", F.round("avg_confidence", DIGITS))


def _sql(body: str) -> str:
    return f"WITH {DETECTIONS_SQL} {body}"


_AVG = "round(avg(confidence), 9) AS avg_confidence"
_LABELS = """SELECT label, {name} AS label_name, detections, avg_confidence FROM (
  SELECT label, label_name AS raw_name, count(*) AS detections, """ + _AVG + """
  FROM detections GROUP BY label, label_name)
ORDER BY detections DESC, label NULLS FIRST, raw_name NULLS FIRST LIMIT {limit}"""
_RECORDINGS = (
    f"SELECT recording_id, count(*) AS detections, {_AVG} FROM detections GROUP BY recording_id"
    " ORDER BY detections DESC, recording_id LIMIT {limit}"
)


def _timeline(minutes: int, index: str = "bucket_index") -> str:
    width = minutes * 60000
    return f"""SELECT {index}, min(s) AS bucket_start_ms,
  CAST(sum(n) AS BIGINT) AS detections, round(avg(c), 9) AS avg_confidence
FROM (SELECT coalesce(chunk_start_ms, 0) AS s, n, c,
             CAST(floor(coalesce(chunk_start_ms, 0) / {width}) AS BIGINT) AS bucket_index
      FROM (SELECT chunk_id, chunk_start_ms, count(*) AS n, avg(confidence) AS c
            FROM detections GROUP BY chunk_id, chunk_start_ms))
GROUP BY bucket_index"""


_SUMMARY = """SELECT count(*) AS detections, count(DISTINCT label) AS label_count,
  count(DISTINCT recording_id) AS recording_count, min(chunk_start_ms) AS first_chunk_ms,
  max(chunk_start_ms) AS last_chunk_ms, CAST({minutes} AS INTEGER) AS bucket_minutes
FROM detections"""


# ---- queries ---------------------------------------------------------------------------


def bucket_timeline(spark, sf_dir):
    return rounded(R.bucket_timeline(detections(spark, sf_dir), 60))


def summarize_label(spark, sf_dir):
    return rounded(R.summarize(detections(spark, sf_dir)))


def summarize_recording_label(spark, sf_dir):
    return rounded(R.summarize(detections(spark, sf_dir), ["recording_id", "label"]))


def label_leaderboard(spark, sf_dir):
    return rounded(R.label_leaderboard(detections(spark, sf_dir), 20))


def recording_leaderboard(spark, sf_dir):
    return rounded(R.recording_leaderboard(detections(spark, sf_dir), 10))


def chunk_timeline(spark, sf_dir):
    return rounded(R.chunk_timeline(detections(spark, sf_dir)))


def named_bucket_timeline(spark, sf_dir):
    return rounded(R.named_buckets(R.bucket_timeline(detections(spark, sf_dir), 30)))


def global_summary(spark, sf_dir):
    return R.global_summary(detections(spark, sf_dir), 60)


def rollup_grain(spark, sf_dir):
    return R.rollup(detections(spark, sf_dir)).withColumn(
        "confidence_sum", F.round("confidence_sum", DIGITS - 2)
    )


def without_placeholders(spark, sf_dir):
    return rounded(R.summarize(exclude_placeholders(detections(spark, sf_dir))))


def _tagged(**tables: DataFrame) -> DataFrame:
    """Named report tables stacked into one, for checking a suite as a whole."""

    rows = [
        df.select(
            F.lit(name).alias("report"),
            df[df.columns[0]].cast("string").alias("key"),
            F.col("detections").cast("bigint").alias("detections"),
            F.round("avg_confidence", DIGITS).alias("avg_confidence"),
        )
        for name, df in tables.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def quicklook_suite(spark, sf_dir):
    rolled = materialise(R.rollup(detections(spark, sf_dir)), "rollup")
    suite = R.quicklook(rolled, 10, 5)
    return _tagged(
        labels=suite.top_labels, recordings=suite.top_recordings, chunks=suite.chunk_timeline
    )


def table_report_suite(spark, sf_dir):
    suite = R.table_report(detections(spark, sf_dir), 20, 10, 60)
    return _tagged(labels=suite.labels, recordings=suite.recordings, timeline=suite.timeline)


def database_report_views(spark, sf_dir):
    location = shared_dir(spark, "reportdb")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    build_report_database(detections(spark, sf_dir), name, 60)
    views = load_views(spark, name, limit_labels=15, limit_recordings=10)
    return _tagged(
        labels=views.label_summary,
        recordings=views.recording_summary,
        timeline=views.timeline_summary,
    )


def timeline_sparkline(spark, sf_dir):
    timeline = R.bucket_timeline(detections(spark, sf_dir), 60)
    return R.timeline_sparkline(timeline).select("sparkline", "buckets")


def folder_rollup_labels(spark, sf_dir):
    folder = shared_dir(spark, "exports")
    write_detections(detections(spark, sf_dir), f"{folder}/all_detections.parquet")
    write_detections(detections(spark, sf_dir), f"{folder}/all_detections_copy.parquet")
    exports = read_detection_folder(spark, folder)
    return rounded(R.folder_rollup(exports, 20)[0])


def folder_rollup_recordings(spark, sf_dir):
    folder = shared_dir(spark, "exports")
    write_detections(detections(spark, sf_dir), f"{folder}/plain.parquet")
    return rounded(R.folder_rollup(read_detection_folder(spark, folder), 20)[1])


def folder_rollup_totals(spark, sf_dir):
    folder = shared_dir(spark, "exports")
    write_detections(detections(spark, sf_dir), f"{folder}/x_detections.parquet", clustered=True)
    return R.folder_rollup(read_detection_folder(spark, folder))[2]


def detection_csv_export(spark, sf_dir):
    path = write_detections_csv(detections(spark, sf_dir), shared_dir(spark, "csv"))
    back = spark.read.csv(path, header=True, escape='"')
    return back.groupBy("label", "status").agg(
        F.count("*").alias("rows"),
        F.count("confidence").alias("with_confidence"),
        F.count("label_name").alias("with_name"),
        F.sum(F.col("chunk_start_ms").cast("bigint")).alias("start_sum"),
    )


def detection_parquet_export(spark, sf_dir):
    path = write_detections(detections(spark, sf_dir), shared_dir(spark, "parquet"), clustered=True)
    return read_detection_table(spark, path).select(
        "recording_id", "chunk_id", "chunk_start_ms", "chunk_end_ms", "timestamp_ms", "label",
        "label_name", "confidence", "source_path",
    )


def report_csv_export(spark, sf_dir):
    report = R.table_report(detections(spark, sf_dir))
    path = write_report_csv(report.timeline, shared_dir(spark, "timeline"))
    back = spark.read.csv(path, header=True)
    return back.select(
        "bucket",
        F.col("bucket_start_ms").cast("bigint").alias("bucket_start_ms"),
        F.col("detections").cast("bigint").alias("detections"),
        F.round(F.col("avg_confidence").cast("double"), DIGITS).alias("avg_confidence"),
    )


def summary_json_export(spark, sf_dir):
    path = write_summary_json(
        R.global_summary(detections(spark, sf_dir), 60), shared_dir(spark, "summary")
    )
    names = ["detections", "label_count", "recording_count", "first_chunk_ms", "last_chunk_ms"]
    return spark.read.json(path).select(
        *names, F.col("bucket_minutes").cast("int").alias("bucket_minutes")
    )


def per_recording_labels(spark, sf_dir):
    return rounded(per_recording_reports(detections(spark, sf_dir))["labels"]).select(
        "recording_id", "label", "label_name", "detections", "avg_confidence", "rank"
    )


def per_recording_timeline(spark, sf_dir):
    return rounded(per_recording_reports(detections(spark, sf_dir))["timeline"])


QUERIES = {
    "bucket_timeline": bucket_timeline,
    "summarize_label": summarize_label,
    "summarize_recording_label": summarize_recording_label,
    "label_leaderboard": label_leaderboard,
    "recording_leaderboard": recording_leaderboard,
    "chunk_timeline": chunk_timeline,
    "named_bucket_timeline": named_bucket_timeline,
    "global_summary": global_summary,
    "rollup_grain": rollup_grain,
    "without_placeholders": without_placeholders,
    "quicklook_suite": quicklook_suite,
    "table_report_suite": table_report_suite,
    "database_report_views": database_report_views,
    "timeline_sparkline": timeline_sparkline,
    "folder_rollup_labels": folder_rollup_labels,
    "folder_rollup_recordings": folder_rollup_recordings,
    "folder_rollup_totals": folder_rollup_totals,
    "detection_csv_export": detection_csv_export,
    "detection_parquet_export": detection_parquet_export,
    "report_csv_export": report_csv_export,
    "summary_json_export": summary_json_export,
    "per_recording_labels": per_recording_labels,
    "per_recording_timeline": per_recording_timeline,
}

_NAMED = "'bucket_' || bucket_index AS bucket"


def _suite(labels: int, recordings: int, name: str, third: str) -> str:
    return _sql(
        "SELECT 'labels' AS report, label AS key, detections, avg_confidence FROM ("
        + _LABELS.format(name=name, limit=labels)
        + ") UNION ALL SELECT 'recordings', recording_id, detections, avg_confidence FROM ("
        + _RECORDINGS.format(limit=recordings)
        + f") UNION ALL {third}"
    )


_SPARK_SQL = """
SELECT CASE WHEN hi = lo THEN repeat('+', len(pts))
       ELSE list_aggregate(list_transform(pts, lambda v:
            substr(' .:-=+*#%@', CAST(trunc((v - lo) / (hi - lo) * 9) AS INTEGER) + 1, 1)),
            'string_agg', '') END AS sparkline, CAST(n AS INTEGER) AS buckets
FROM (SELECT pts, n, list_min(pts) AS lo, list_max(pts) AS hi FROM (
  SELECT n, CASE WHEN n > 80 THEN list_transform(range(80),
            lambda i: s[CAST(trunc(i * (n / 80)) AS INTEGER) + 1]) ELSE s END AS pts
  FROM (SELECT list(CAST(detections AS DOUBLE) ORDER BY bucket_start_ms, bucket_index) AS s,
               count(*) AS n FROM t)))"""

ORACLE = {
    "bucket_timeline": _sql(_timeline(60)),
    "summarize_label": _sql(f"SELECT label, count(*) AS detections, {_AVG} FROM detections GROUP BY label"),
    "summarize_recording_label": _sql(
        f"SELECT recording_id, label, count(*) AS detections, {_AVG}"
        " FROM detections GROUP BY recording_id, label"
    ),
    "label_leaderboard": _sql(_LABELS.format(name="nullif(raw_name, '')", limit=20)),
    "recording_leaderboard": _sql(_RECORDINGS.format(limit=10)),
    "chunk_timeline": _sql(
        f"SELECT chunk_id, min(chunk_start_ms) AS chunk_start_ms, count(*) AS detections, {_AVG}"
        " FROM detections GROUP BY chunk_id"
    ),
    "named_bucket_timeline": _sql(_timeline(30, _NAMED)),
    "global_summary": _sql(_SUMMARY.format(minutes=60)),
    "rollup_grain": _sql(
        "SELECT recording_id, chunk_id, chunk_start_ms, label, label_name,"
        " count(*) AS rolled_detections, round(sum(confidence), 7) AS confidence_sum,"
        " count(confidence) AS confidence_count FROM detections"
        " GROUP BY recording_id, chunk_id, chunk_start_ms, label, label_name"
    ),
    "without_placeholders": _sql(
        f"SELECT label, count(*) AS detections, {_AVG} FROM detections"
        " WHERE NOT (label = 'none' AND timestamp_ms IS NULL AND confidence IS NULL)"
        " GROUP BY label"
    ),
    "quicklook_suite": _suite(
        10, 5, "nullif(raw_name, '')",
        f"SELECT 'chunks', chunk_id, count(*), {_AVG} FROM detections GROUP BY chunk_id",
    ),
    "table_report_suite": _suite(
        20, 10, "nullif(raw_name, '')",
        f"SELECT 'timeline', bucket, detections, avg_confidence FROM ({_timeline(60, _NAMED)})",
    ),
    "database_report_views": _suite(
        15, 10, "coalesce(raw_name, '')",
        "SELECT 'timeline', CAST(bucket_index AS VARCHAR), detections, avg_confidence"
        f" FROM ({_timeline(60)})",
    ),
    "timeline_sparkline": f"WITH {DETECTIONS_SQL}, t AS ({_timeline(60)}) {_SPARK_SQL}",
    "folder_rollup_labels": _sql(_LABELS.format(name="raw_name", limit=20)),
    "folder_rollup_recordings": _sql(_RECORDINGS.format(limit=20)),
    "folder_rollup_totals": _sql(
        "SELECT count(*) AS detections, count(DISTINCT recording_id) AS recording_count FROM detections"
    ),
    "detection_csv_export": _sql(
        "SELECT label, CASE WHEN label = 'none' THEN 'unknown' ELSE 'ok' END AS status,"
        " count(*) AS rows, count(confidence) AS with_confidence,"
        " count(nullif(label_name, '')) AS with_name,"
        " CAST(sum(chunk_start_ms) AS BIGINT) AS start_sum FROM detections GROUP BY 1, 2"
    ),
    "detection_parquet_export": _sql(
        "SELECT recording_id, chunk_id, chunk_start_ms, chunk_end_ms, timestamp_ms, label,"
        " label_name, confidence, source_path FROM detections"
    ),
    "report_csv_export": _sql(_timeline(60, _NAMED)),
    "summary_json_export": _sql(_SUMMARY.format(minutes=60)),
    "per_recording_labels": _sql(
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY"
        " detections DESC, label NULLS FIRST, label_name NULLS FIRST) AS INTEGER) AS rank FROM ("
        f"SELECT recording_id, label, label_name, count(*) AS detections, {_AVG}"
        " FROM detections GROUP BY recording_id, label, label_name)) WHERE rank <= 20"
    ),
    "per_recording_timeline": _sql(
        "SELECT recording_id, bucket_index, min(s) AS bucket_start_ms,"
        " CAST(sum(n) AS BIGINT) AS detections, round(avg(c), 9) AS avg_confidence FROM ("
        " SELECT recording_id, coalesce(chunk_start_ms, 0) AS s, n, c,"
        " CAST(floor(coalesce(chunk_start_ms, 0) / 3600000) AS BIGINT) AS bucket_index FROM ("
        "  SELECT recording_id, chunk_id, chunk_start_ms, count(*) AS n, avg(confidence) AS c"
        "  FROM detections GROUP BY recording_id, chunk_id, chunk_start_ms))"
        " GROUP BY recording_id, bucket_index"
    ),
}
