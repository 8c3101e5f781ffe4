"""Place and time of recordings, merged overlaps, sites, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoledger.operators.field import (
    attach_sites,
    changed_windows,
    merge_overlaps,
    merge_study_areas,
    quality_counts,
    runtime_and_confidence,
    with_recording_facts,
)
from workload.proxies import (
    DETECTIONS_SQL,
    JOB_RESULTS_SQL,
    TELEMETRY_SQL,
    detections,
    job_results,
    table,
    telemetry,
)


def recording_facts(spark, sf_dir):
    """Orders as recordings in two folder layouts, one in nine without a time."""

    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('/raw/Area', o_custkey % 7, if(o_orderkey % 2 = 0, concat('/ARU_data/SM/ST-', o_custkey, '/A/Data/'),"
        " concat('/ST-', o_custkey, '/')), 'S4A', o_custkey, '_0+1_',"
        " if(o_orderkey % 9 = 0, 'untimed', concat(date_format(o_orderdate, 'yyyyMMdd'), '_',"
        " lpad(o_orderkey % 24, 2, '0'), '3059')), '.wav') AS source_path",
    )
    facts = with_recording_facts(rows, "/raw")
    return facts.select(
        "o_orderkey", "study_area", "location",
        F.date_format("recording_date_time", "yyyy-MM-dd HH:mm:ss").alias("recorded"),
    )


def merged_overlaps(spark, sf_dir):
    found = merge_overlaps(detections(spark, sf_dir), gap_ms=60_000)
    return found.select(
        "recording_id", "label", "absolute_time_ms", "absolute_end_ms", "confidence", "merged"
    )


def study_area_table(spark, sf_dir):
    rows = detections(spark, sf_dir).withColumn("set", F.regexp_extract("source_path", "/data/(set_[0-9]+)/", 1))
    areas = {f"area_{k}": rows.filter(F.col("set") == f"set_{k}").drop("set") for k in range(5)}
    merged = merge_study_areas(areas, ["CLIC", "ERRO"])
    return merged.groupBy("study_area", "label_code").agg(F.count("*").alias("rows"))


def runtime_confidence(spark, sf_dir):
    heard = table(spark, sf_dir, "events").selectExpr(
        "concat('chunk_', event_id div 3 * 3) AS chunk_id", "if(event_id % 4 = 0, NULL, value) AS confidence"
    )
    return runtime_and_confidence(telemetry(spark, sf_dir), heard).select(
        "chunk_id", "successes", "runtime_s", "gpu_index", "detections", F.round("avg_confidence", 9).alias("avg_confidence")
    )


def site_detections(spark, sf_dir):
    sites = table(spark, sf_dir, "nation").selectExpr("concat('st_', n_nationkey) AS location", "n_name AS site")
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "concat('st_', user_id % 30) AS location")
    return attach_sites(rows, sites).select("event_id", "location", "site")


def quality_report(spark, sf_dir):
    return quality_counts(job_results(spark, sf_dir), detections(spark, sf_dir), low=20.0)


def changed_audio(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "concat('rec_', o_custkey) AS recording_id", "concat('chunk_', o_orderkey) AS chunk_id", "o_orderkey AS k"
    )
    manifest = orders.selectExpr(
        "recording_id", "chunk_id", "if(k % 5 = 0, NULL, sha2(concat('c', k - if(k % 7 = 0, 1, 0)), 256)) AS sha256"
    )
    blobs = orders.selectExpr("recording_id", "chunk_id", "if(k % 11 = 0, NULL, cast(concat('c', k) AS binary)) AS content")
    return changed_windows(manifest, blobs).select("recording_id", "chunk_id", "problem")


QUERIES = {
    "recording_facts": recording_facts,
    "merged_overlaps": merged_overlaps,
    "study_area_table": study_area_table,
    "runtime_confidence": runtime_confidence,
    "site_detections": site_detections,
    "quality_report": quality_report,
    "changed_audio": changed_audio,
}

ORACLE = {
    "recording_facts": """
SELECT o_orderkey, 'Area' || o_custkey % 7 AS study_area, 'ST-' || o_custkey AS location,
       CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' '
         || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:59' END AS recorded
FROM orders""",
    "merged_overlaps": f"""WITH {DETECTIONS_SQL},
d AS (SELECT recording_id, label, ms AS t0, ms + 900 AS t1, confidence
      FROM (SELECT 'rec_' || user_id AS recording_id, event_type AS label, ms, value AS confidence
            FROM timed WHERE event_id % 11 <> 0)),
f AS (SELECT *, CASE WHEN t0 <= max(t1) OVER (PARTITION BY recording_id, label ORDER BY t0, t1
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 60000 THEN 0 ELSE 1 END AS fresh FROM d),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY recording_id, label ORDER BY t0, t1, confidence DESC
                 ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT recording_id, label, min(t0) AS absolute_time_ms, max(t1) AS absolute_end_ms,
       max(confidence) AS confidence, count(*) AS merged FROM r GROUP BY recording_id, label, run
UNION ALL SELECT recording_id, label, NULL, NULL, confidence, 1 FROM detections
WHERE timestamp_ms IS NULL""",
    "study_area_table": f"""WITH {DETECTIONS_SQL}
SELECT 'area_' || user_id % 5 AS study_area, upper(substr(event_type, 1, 4)) AS label_code, count(*) AS rows
FROM timed WHERE upper(substr(event_type, 1, 4)) IN ('CLIC', 'ERRO') GROUP BY 1, 2""",
    "runtime_confidence": f"""WITH {TELEMETRY_SQL},
h AS (SELECT 'chunk_' || (event_id // 3 * 3) AS chunk_id,
             count(*) FILTER (event_id % 4 <> 0) AS detections,
             avg(value) FILTER (event_id % 4 <> 0) AS avg_confidence FROM events GROUP BY 1),
f AS (SELECT flat.chunk_id, count(*) FILTER (status = 'SUCCESS') AS successes,
             max(runtime_s) FILTER (status = 'SUCCESS') AS runtime_s,
             max(CASE WHEN device <> 'CPU' THEN CAST(device[5:] AS BIGINT) END) AS gpu_index FROM flat GROUP BY 1)
SELECT chunk_id, successes, runtime_s, gpu_index, coalesce(detections, 0) AS detections,
       round(avg_confidence, 9) AS avg_confidence FROM f LEFT JOIN h USING (chunk_id)""",
    "site_detections": """
SELECT event_id, 'st_' || user_id % 30 AS location, n_name AS site
FROM events LEFT JOIN nation ON n_nationkey = user_id % 30""",
    "quality_report": f"""WITH {JOB_RESULTS_SQL}, {DETECTIONS_SQL},
r AS (SELECT recording_id, count(*) AS chunks, count(*) FILTER (status <> 'success') AS failures
      FROM job_results GROUP BY 1),
h AS (SELECT recording_id, count(confidence) AS detections, count(*) FILTER (confidence < 20.0) AS low_confidence
      FROM detections GROUP BY 1)
SELECT coalesce(r.recording_id, h.recording_id) AS recording_id, coalesce(chunks, 0) AS chunks,
       coalesce(failures, 0) AS failures, coalesce(detections, 0) AS detections,
       coalesce(low_confidence, 0) AS low_confidence
FROM r FULL JOIN h ON r.recording_id IS NOT DISTINCT FROM h.recording_id""",
    "changed_audio": """
SELECT 'rec_' || o_custkey AS recording_id, 'chunk_' || o_orderkey AS chunk_id,
       CASE WHEN o_orderkey % 11 = 0 THEN 'missing' ELSE 'changed' END AS problem
FROM orders WHERE o_orderkey % 11 = 0 OR (o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0)""",
}
