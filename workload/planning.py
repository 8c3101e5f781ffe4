"""Incremental planning, status, scoring and their exports."""

from __future__ import annotations

import struct
import wave

from pyspark.sql import functions as F

from sonoledger.operators.audio import export_wav_files
from sonoledger.operators.bundle import BundleOptions, load_views, write_bundle
from sonoledger.operators.ingest import enrich_payloads, explode_detections
from sonoledger.operators.score import (
    ScoreOptions,
    event_rows,
    payload_rows,
    read_payload_lines,
    result_rows,
    score_windows,
    write_payload_json,
)
from sonoledger.operators.telemetry import device_summary, worker_totals
from sonoledger.plans.chunk_plan import build_chunk_plan, runnable_plans
from sonoledger.plans.dataset_run import cut_dataset, dataset_manifest, run_dataset
from sonoledger.plans.infer_plan import build_infer_plan, incomplete_plans, output_locations
from sonoledger.plans.resume import orphan_counts, pending_jobs, resume_entries, unmatched_entries
from sonoledger.session import materialise, shared_dir
from sonoledger.sources.manifests import read_plan_manifests
from sonoledger.sources.status import append_status, latest_status, read_status
from sonoledger.sources.tables import write_plan
from sonoledger.sources.telemetry import append_telemetry, read_telemetry
from workload.proxies import (
    CUSTOMER_SQL,
    DETECTIONS_SQL,
    JOB_RESULTS_SQL,
    JOBS_SQL,
    STATUS_SQL,
    customer_recordings,
    detections,
    job_results,
    jobs,
    status_rows,
    table,
)
from workload.windows import write_audio


def pending_windows(spark, sf_dir):
    """Resume: windows no earlier success covers, with and without a recording."""

    entries = resume_entries(job_results(spark, sf_dir))
    return pending_jobs(jobs(spark, sf_dir), entries).select("recording_id", "chunk_id")


def _shifted_results(spark, sf_dir):
    """Outcomes of which every third names a window this manifest does not have."""

    return job_results(spark, sf_dir).withColumn(
        "chunk_id", F.expr("if(attempts = 3, concat(chunk_id, '_gone'), chunk_id)")
    )


def resume_orphans(spark, sf_dir):
    entries = resume_entries(_shifted_results(spark, sf_dir))
    return orphan_counts(jobs(spark, sf_dir), entries)


def resume_unmatched(spark, sf_dir):
    entries = resume_entries(_shifted_results(spark, sf_dir))
    return unmatched_entries(jobs(spark, sf_dir), entries)


def status_latest(spark, sf_dir):
    path = append_status(status_rows(spark, sf_dir), shared_dir(spark, "status"))
    return latest_status(read_status(spark, path)).select(
        "recording_id", "status", "updated_at", "manifest_rows"
    )


def _manifests(spark, sf_dir):
    """Customers with an order have a manifest."""

    return table(spark, sf_dir, "orders").selectExpr("concat('rec_', o_custkey) AS recording_id")


def _chunk_plan(spark, sf_dir, **options):
    return build_chunk_plan(
        customer_recordings(spark, sf_dir), _manifests(spark, sf_dir), status_rows(spark, sf_dir),
        "/data", **options,
    )


def chunk_plan(spark, sf_dir):
    return _chunk_plan(spark, sf_dir).select(
        "recording_id", "audio_path", "manifest_path", "chunk_output_dir", "chunk_duration",
        "overlap",
    )


def chunk_plan_limited(spark, sf_dir):
    plan = _chunk_plan(spark, sf_dir, include_existing=True, limit=25)
    return plan.select("recording_id", "audio_path", "status", "has_manifest")


def chunk_plan_runnable(spark, sf_dir):
    plan = _chunk_plan(spark, sf_dir, include_existing=True)
    return runnable_plans(plan).select("recording_id", "status", "has_manifest")


def _infer_plan(spark, sf_dir, **options):
    manifests = customer_recordings(spark, sf_dir).selectExpr(
        "recording_id", "concat('/data/manifests/', recording_id, '.csv') AS manifest_path"
    )
    outputs = job_results(spark, sf_dir).filter("status = 'success'").select("recording_id").distinct()
    return build_infer_plan(
        manifests, outputs, status_rows(spark, sf_dir), output_dir="/data/infer",
        telemetry_dir="/data/telemetry", **options,
    )


def infer_plan(spark, sf_dir):
    return _infer_plan(spark, sf_dir).select(
        "recording_id", "manifest_path", "output_dir", "recording_output_dir", "telemetry_log",
        "chunk_status",
    )


def infer_plan_incomplete(spark, sf_dir):
    return incomplete_plans(_infer_plan(spark, sf_dir))


def infer_plan_locations(spark, sf_dir):
    plan = _infer_plan(spark, sf_dir).withColumn(
        "output_dir", F.concat("output_dir", F.lit("/"), F.coalesce("chunk_status", F.lit("none")))
    )
    return output_locations(plan)


def saved_plan_restriction(spark, sf_dir):
    """A chunk plan saved as CSV narrows the next stage to its manifests."""

    path = write_plan(_chunk_plan(spark, sf_dir), shared_dir(spark, "plan"))
    saved = read_plan_manifests(spark, path)
    return _infer_plan(spark, sf_dir, saved_plan=saved, include_existing=True).select(
        "recording_id", "manifest_path", "chunk_status"
    )


def plan_json_scan(spark, sf_dir):
    path = write_plan(_chunk_plan(spark, sf_dir), shared_dir(spark, "plan") + ".json", "json")
    return read_plan_manifests(spark, path, lines=True).select("recording_id", "manifest_path")


# ---- scoring ---------------------------------------------------------------------------


def _bits(n):
    return [
        {"timestamp_ms": bit * 1000, "end_ms": bit * 1000 + 900, "label": f"B{bit}",
         "label_name": f"bit {bit}", "confidence": n / 1000}
        for bit in range(3)
        if n >> bit & 1
    ]


def _detector():
    """One detection per set bit of the window number; some windows fail once, some always."""

    seen = set()

    def detect(job):
        n = job["start_ms"] // 60000
        if n % 50 == 49:
            raise RuntimeError(f"window {n} is silent")
        if n % 50 == 24 and n not in seen:
            seen.add(n)
            raise RuntimeError(f"window {n} stutters")
        return _bits(n)

    return detect


def _detect_many(batch):
    """The same for a batch, of which about one in two holds a window that spoils it."""

    numbers = [job["start_ms"] // 60000 for job in batch]
    if spoiled := [n for n in numbers if n % 128 == 127]:
        raise RuntimeError(f"window {spoiled[0]} is silent" if len(numbers) == 1 else "batch fails")
    return [_bits(n) for n in numbers]


def _sampler(gpu):
    return {"index": 0, "name": "Unit 0", "utilization": 41.5, "memory_used_mb": 512.0, "memory_total_mb": 8192.0}


def _scored(spark, sf_dir):
    # This detector takes microseconds, so a task gets far more than the default and nothing waits.
    options = ScoreOptions(detector=_detector(), sampler=_sampler, backoff_limit_s=0, windows_per_task=20_000)
    return materialise(score_windows(jobs(spark, sf_dir), options), "scored")


def scored_batches(spark, sf_dir):
    """Batches of 64, halved down to the windows that spoil them."""

    options = ScoreOptions(batch_detector=_detect_many, batch_size=64, backoff_limit_s=0, windows_per_task=20_000)
    scored = materialise(score_windows(jobs(spark, sf_dir), options), "scored")
    return result_rows(scored).join(scored.select("chunk_id", F.size("detections").alias("found")), "chunk_id").select(
        "chunk_id", "recording_id", "status", "attempts", "retries", "last_error", "found"
    )


def scored_devices(spark, sf_dir):
    """A run's own events, appended to the log, read back and summed up by device."""

    log = append_telemetry(event_rows(_scored(spark, sf_dir)), shared_dir(spark, "log"))
    totals = device_summary(read_telemetry(spark, log))
    return totals.select(
        "device", "name", "events", "success", "failures", "retry_attempts", "retry_events", "failure_attempts",
        "util_min", "util_avg", "util_max", "max_memory", "memory_total",
        F.aggregate("util_history", F.lit(0.0), lambda a, v: a + v).alias("util_sum"), F.size("retry_history").alias("samples"),
    )


def scored_detections(spark, sf_dir):
    """Detector output through the payload shape into the canonical table."""

    scored = _scored(spark, sf_dir)
    found = explode_detections(enrich_payloads(payload_rows(scored)))
    return found.select(
        "recording_id", "chunk_id", "chunk_start_ms", "absolute_time_ms", "label", "label_name",
        "confidence", "status", "runner", "chunk_sha256", "source_path",
    )


def scored_results(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return result_rows(scored).select(
        "chunk_id", "recording_id", "status", "attempts", "retries", "last_error", "error"
    )


def scored_events(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return event_rows(scored).groupBy("status").agg(
        F.count("*").alias("events"), F.sum("details.attempt").alias("attempts")
    )


def scored_totals(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    totals = worker_totals(result_rows(scored))
    return totals.agg(*[F.sum(c).alias(c) for c in ("jobs", "success", "failure", "retries")])


def stub_payload_files(spark, sf_dir):
    """The stub detector's payloads written many to a file by recording, read back and exploded."""

    options = ScoreOptions(windows_per_task=20_000)
    scored = materialise(score_windows(jobs(spark, sf_dir), options), "scored")
    path = write_payload_json(scored, shared_dir(spark, "payloads"))
    found = explode_detections(enrich_payloads(read_payload_lines(spark, path)))
    return found.select(
        "recording_id", "chunk_id", "chunk_start_ms", "chunk_end_ms", "label", "status", "runner",
        "chunk_sha256",
    )


def _catalog(spark, name):
    """A catalog database of its own below the shared folder."""

    location = shared_dir(spark, name)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    return database


def report_bundle(spark, sf_dir):
    """Every export of a bundle with its defaults, the stored views too: rows and their values, by file."""

    base = shared_dir(spark, "bundle")
    written = write_bundle(detections(spark, sf_dir), base, "run", database=_catalog(spark, "bundledb"))
    views = load_views(spark, written["database"])
    exports = {
        f"{key}_{name}": spark.read.csv(f"{written[key]}/{name}.csv", header=True)
        for key, name in [
            ("quicklook", "labels"), ("quicklook", "recordings"), ("quicklook", "chunks"),
            ("table", "labels"), ("table", "recordings"), ("table", "timeline"),
            ("database_exports", "label_summary"), ("database_exports", "recording_summary"), ("database_exports", "timeline"),
        ]
    }
    exports |= {"view_labels": views.label_summary, "view_recordings": views.recording_summary, "view_timeline": views.timeline_summary}
    rows = None
    for name, export in exports.items():
        part = export.agg(
            F.lit(name).alias("export"),
            F.count("*").alias("rows"),
            F.sum(F.col("detections").cast("bigint")).alias("detections"),
            F.round(F.sum(F.col("avg_confidence").cast("double")), 6).alias("confidence_sum"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


# ---- whole-dataset jobs: benchmark texts as recordings -----------------------------------


def _dataset(spark, sf_dir):
    root = shared_dir(spark, "dataset").removeprefix("file://")
    write_audio(spark, sf_dir, root, "benchmark")
    return root


def dataset_cut(spark, sf_dir):
    """Discover, plan, cut and record every recording of a dataset."""

    done = cut_dataset(spark, _dataset(spark, sf_dir), 3.0, 1.0)
    return done.select("recording_id", "status", "manifest_rows", "chunk_duration", "overlap")


def _label_even_seconds(job):
    second = job["start_ms"] // 1000
    return [{"timestamp_ms": 0, "label": "even", "confidence": 0.5}] if second % 4 == 0 else []


def dataset_run(spark, sf_dir):
    """From audio files to the dataset rollup."""

    root = _dataset(spark, sf_dir)
    options = ScoreOptions(detector=_label_even_seconds, windows_per_task=20_000)
    out = run_dataset(spark, root, 3.0, 1.0, options, BundleOptions(), rollup_limit=5, run_name=_catalog(spark, "rundb"))
    load_views(spark, out["database"])  # raises if the stored report is not whole
    back = spark.read.csv(f"{out['rollup']}/label_summary.csv", header=True)
    return back.select(
        "label",
        F.col("detections").cast("bigint").alias("detections"),
        F.col("avg_confidence").cast("double").alias("avg_confidence"),
    )


def _label_first_sample(job):
    """The label and confidence are taken from the window's audio."""

    with wave.open(job["source_path"]) as audio:
        samples = audio.readframes(audio.getnframes())
    return [{"timestamp_ms": 0, "label": f"byte_{samples[0]}", "confidence": len(samples) / 100}]


def dataset_run_audio(spark, sf_dir):
    """The same with a detector that opens each window's file."""

    root = _dataset(spark, sf_dir)
    options = ScoreOptions(detector=_label_first_sample, windows_per_task=20_000)
    out = run_dataset(spark, root, 3.0, 1.0, options, None, rollup_limit=1000)
    back = spark.read.csv(f"{out['rollup']}/label_summary.csv", header=True)
    return back.select(
        "label",
        F.col("detections").cast("bigint").alias("detections"),
        F.round(F.col("avg_confidence").cast("double"), 9).alias("avg_confidence"),
    )


def dataset_cut_odd_files(spark, sf_dir):
    """Equal file names in several folders, files that are no PCM, files that end early."""

    root = shared_dir(spark, "dataset").removeprefix("file://")
    rows = table(spark, sf_dir, "benchmark").filter("length(text) > 0").select(
        F.col("item_id").cast("string").alias("chunk_id"),
        F.expr(f"concat('{root}/audio/g', item_id % 4, '/take_', item_id div 4, '.wav')").alias("source_path"),
        F.col("text").cast("binary").alias("data"),
        F.expr("if(item_id % 10 = 3, 3, 1)").alias("tag"),
        F.expr("if(item_id % 10 = 7, 50, 0)").alias("missing"),
    )

    def build(batches):
        for batch in batches:
            content = [
                struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(d) + m, b"WAVE", b"fmt ", 16, t, 1, 10, 10, 1, 8,
                            b"data", len(d) + m) + d
                for d, t, m in zip(batch["data"], batch["tag"], batch["missing"])
            ]
            yield batch[["chunk_id", "source_path"]].assign(content=content)

    files = rows.mapInPandas(build, "chunk_id STRING, source_path STRING, content BINARY")
    export_wav_files(files).write.format("noop").mode("overwrite").save()
    done = cut_dataset(spark, root, 3.0, 1.0, write_files=False)
    return done.select("recording_id", "status", "manifest_rows")


def dataset_manifest_rows(spark, sf_dir):
    """The manifest after a dataset was cut twice: the newer windows count."""

    root = _dataset(spark, sf_dir)
    cut_dataset(spark, root, 5.0)
    cut_dataset(spark, root, 3.0, 1.0, include_existing=True)
    return dataset_manifest(spark, root).select("recording_id", "chunk_id", "start_ms", "end_ms")


QUERIES = {
    "dataset_cut": dataset_cut,
    "dataset_run": dataset_run,
    "dataset_run_audio": dataset_run_audio,
    "dataset_cut_odd_files": dataset_cut_odd_files,
    "dataset_manifest_rows": dataset_manifest_rows,
    "pending_windows": pending_windows,
    "resume_orphans": resume_orphans,
    "resume_unmatched": resume_unmatched,
    "status_latest": status_latest,
    "chunk_plan": chunk_plan,
    "chunk_plan_limited": chunk_plan_limited,
    "chunk_plan_runnable": chunk_plan_runnable,
    "infer_plan": infer_plan,
    "infer_plan_incomplete": infer_plan_incomplete,
    "infer_plan_locations": infer_plan_locations,
    "saved_plan_restriction": saved_plan_restriction,
    "plan_json_scan": plan_json_scan,
    "scored_detections": scored_detections,
    "scored_results": scored_results,
    "scored_events": scored_events,
    "scored_totals": scored_totals,
    "scored_batches": scored_batches,
    "scored_devices": scored_devices,
    "stub_payload_files": stub_payload_files,
    "report_bundle": report_bundle,
}

_PLAN = f"""WITH {CUSTOMER_SQL}, {STATUS_SQL},
have AS (SELECT DISTINCT 'rec_' || o_custkey AS recording_id FROM orders),
plan AS (
  SELECT c.*, l.status, h.recording_id IS NOT NULL AS has_manifest,
         '/data/manifests/' || c.recording_id || '.csv' AS manifest_path
  FROM customers c LEFT JOIN have h USING (recording_id) LEFT JOIN latest l USING (recording_id)
),
todo AS (SELECT * FROM plan WHERE NOT has_manifest OR coalesce(status IN ('failed', 'in_progress'), false)),
done AS (
  SELECT DISTINCT 'rec_' || o_custkey AS recording_id FROM orders
  WHERE o_orderkey % 5 <> 0 AND o_orderstatus = 'F'
),
open AS (SELECT * FROM plan WHERE recording_id NOT IN (SELECT recording_id FROM done))
"""
_RESUME = f"""WITH {JOBS_SQL}, {JOB_RESULTS_SQL},
entries AS (SELECT DISTINCT recording_id, chunk_id FROM job_results WHERE status = 'success'),
moved AS (SELECT DISTINCT recording_id,
            CASE WHEN attempts = 3 THEN chunk_id || '_gone' ELSE chunk_id END AS chunk_id
          FROM job_results WHERE status = 'success')
"""


def _pending(entries: str) -> str:
    return f"""jobs j WHERE NOT EXISTS (SELECT 1 FROM {entries} e WHERE e.chunk_id = j.chunk_id
  AND (e.recording_id IS NULL OR e.recording_id = j.recording_id))"""


_SCORED = f"""WITH {JOBS_SQL},
ok AS (SELECT * FROM jobs WHERE o_orderkey % 50 <> 49),
bits AS (SELECT ok.*, b FROM ok LEFT JOIN (SELECT unnest(range(0, 3)) AS b) bs
         ON (o_orderkey >> b) & 1 = 1)
"""

# Windows with the tries they take: three in vain, two, or one.
_TRIED = f"""WITH {JOBS_SQL},
s AS (SELECT *, o_orderkey % 50 = 49 AS bad,
             CASE o_orderkey % 50 WHEN 49 THEN 3 WHEN 24 THEN 2 ELSE 1 END AS tries FROM jobs)
"""

_AUDIO = """WITH t AS (SELECT 'rec_' || item_id AS recording_id, octet_length(encode(text)) AS n, text
  FROM benchmark WHERE octet_length(encode(text)) > 0),
w AS (SELECT *, CAST(trunc(s / 10 * 1000) AS BIGINT) AS start_ms,
             CAST(trunc(least(s + 30, n) / 10 * 1000) AS BIGINT) AS end_ms
      FROM (SELECT *, unnest(range(0, n, 20)) AS s FROM t))
"""

ORACLE = {
    "dataset_cut": f"""{_AUDIO}
SELECT recording_id, 'completed' AS status, count(*) AS manifest_rows, 3.0::DOUBLE AS chunk_duration,
       1.0::DOUBLE AS overlap FROM w GROUP BY recording_id""",
    "dataset_run": f"""{_AUDIO}
SELECT CASE WHEN start_ms % 4000 = 0 THEN 'even' ELSE 'none' END AS label, count(*) AS detections,
       avg(CASE WHEN start_ms % 4000 = 0 THEN 0.5::DOUBLE END) AS avg_confidence FROM w GROUP BY 1""",
    "dataset_run_audio": f"""{_AUDIO}
SELECT 'byte_' || CAST('0x' || hex(encode(text))[2 * s + 1 : 2 * s + 2] AS INTEGER) AS label, count(*) AS detections,
       round(avg((least(s + 30, n) - s) / 100), 9) AS avg_confidence FROM w GROUP BY 1""",
    "dataset_cut_odd_files": """
WITH t AS (
  SELECT item_id, octet_length(encode(text)) AS n, CASE WHEN item_id % 10 = 7 THEN 50 ELSE 0 END AS missing,
         count(*) OVER (PARTITION BY item_id // 4) > 1 AS repeated
  FROM benchmark WHERE length(text) > 0
),
w AS (SELECT *, unnest(range(0, n + missing, 20)) AS s FROM t)
SELECT CASE WHEN repeated THEN 'g' || item_id % 4 || '__' ELSE '' END || 'take_' || item_id // 4 AS recording_id,
       CASE WHEN item_id % 10 IN (3, 7) THEN 'failed' ELSE 'completed' END AS status,
       count(*) FILTER (item_id % 10 <> 3 AND least(s + 30, n + missing) <= n) AS manifest_rows
FROM w GROUP BY ALL""",
    "dataset_manifest_rows": f"""{_AUDIO}
SELECT recording_id, recording_id || '_chunk_' || start_ms || '_' || end_ms AS chunk_id, start_ms, end_ms
FROM w""",
    "pending_windows": f"{_RESUME} SELECT recording_id, chunk_id FROM {_pending('entries')}",
    "resume_orphans": f"""{_RESUME},
n AS (SELECT (SELECT count(*) FROM moved) AS entries, (SELECT count(*) FROM jobs) -
        (SELECT count(*) FROM {_pending('moved')}) AS skipped)
SELECT entries, skipped, greatest(entries - skipped, 0) AS orphaned FROM n""",
    "resume_unmatched": f"""{_RESUME}
SELECT recording_id, chunk_id FROM moved WHERE chunk_id LIKE '%_gone'""",
    "status_latest": f"WITH {STATUS_SQL} SELECT * FROM latest",
    "chunk_plan": f"""{_PLAN}
SELECT recording_id, audio_path, manifest_path,
       '/data/artifacts/chunks/' || recording_id AS chunk_output_dir,
       60.0::DOUBLE AS chunk_duration, 0.0::DOUBLE AS overlap FROM todo""",
    "chunk_plan_limited": f"""{_PLAN}
SELECT recording_id, audio_path, status, has_manifest FROM plan ORDER BY audio_path LIMIT 25""",
    "chunk_plan_runnable": f"""{_PLAN}
SELECT recording_id, status, has_manifest FROM plan
WHERE NOT (coalesce(status = 'completed', false) AND has_manifest)""",
    "infer_plan": f"""{_PLAN}
SELECT recording_id, manifest_path, '/data/infer' AS output_dir,
       '/data/infer/' || recording_id AS recording_output_dir,
       '/data/telemetry/infer/' || recording_id || '.jsonl' AS telemetry_log,
       status AS chunk_status FROM open""",
    "infer_plan_incomplete": f"""{_PLAN}
SELECT recording_id, coalesce(status, 'missing') AS chunk_status FROM open
WHERE coalesce(status, 'missing') <> 'completed'""",
    "infer_plan_locations": f"""{_PLAN}
SELECT DISTINCT '/data/infer/' || coalesce(status, 'none') AS output_dir FROM open
ORDER BY output_dir LIMIT 3""",
    "saved_plan_restriction": f"""{_PLAN}
SELECT recording_id, manifest_path, status AS chunk_status FROM todo""",
    "plan_json_scan": f"{_PLAN} SELECT recording_id, manifest_path FROM todo",
    "scored_detections": f"""{_SCORED}
SELECT recording_id, chunk_id, start_ms AS chunk_start_ms, start_ms + b * 1000 AS absolute_time_ms,
       CASE WHEN b IS NULL THEN 'none' ELSE 'B' || b END AS label, 'bit ' || b AS label_name,
       CASE WHEN b IS NOT NULL THEN o_orderkey / 1000 END AS confidence, 'ok' AS status,
       'custom' AS runner, sha256 AS chunk_sha256, source_path FROM bits""",
    "scored_results": f"""{_TRIED}
SELECT chunk_id, recording_id, CASE WHEN bad THEN 'failure' ELSE 'success' END AS status,
       CAST(tries AS INTEGER) AS attempts, CASE WHEN bad THEN NULL ELSE CAST(tries - 1 AS INTEGER) END AS retries,
       CASE WHEN bad THEN 'window ' || o_orderkey || ' is silent'
            WHEN tries = 2 THEN 'window ' || o_orderkey || ' stutters' END AS last_error,
       CASE WHEN bad THEN 'failed after 3 attempt(s)' END AS error FROM s""",
    "scored_events": f"""{_TRIED},
e AS (SELECT bad, tries, unnest(range(1, tries + 1)) AS k FROM s)
SELECT 'start' AS status, count(*) AS events, CAST(sum(k) AS DOUBLE) AS attempts FROM e
UNION ALL SELECT CASE WHEN bad OR k < tries THEN 'failure' ELSE 'success' END, count(*), CAST(sum(k) AS DOUBLE)
FROM e GROUP BY 1""",
    "scored_totals": f"""{_TRIED}
SELECT count(*) AS jobs, count(*) FILTER (WHERE NOT bad) AS success, count(*) FILTER (WHERE bad) AS failure,
       CAST(coalesce(sum(tries - 1) FILTER (WHERE NOT bad), 0) AS BIGINT) AS retries FROM s""",
    "scored_batches": f"""WITH {JOBS_SQL}, s AS (SELECT *, o_orderkey % 128 = 127 AS bad FROM jobs)
SELECT chunk_id, recording_id, CASE WHEN bad THEN 'failure' ELSE 'success' END AS status,
       CAST(CASE WHEN bad THEN 3 ELSE 1 END AS INTEGER) AS attempts,
       CASE WHEN NOT bad THEN CAST(0 AS INTEGER) END AS retries,
       CASE WHEN bad THEN 'window ' || o_orderkey || ' is silent' END AS last_error,
       CAST(CASE WHEN bad THEN 0 ELSE bit_count(o_orderkey % 8) END AS INTEGER) AS found FROM s""",
    "scored_devices": f"""{_TRIED},
e AS (SELECT bad, tries, unnest(range(1, tries + 1)) AS k FROM s)
SELECT 'GPU 0' AS device, 'Unit 0' AS name, 2 * count(*) AS events,
       count(*) FILTER (WHERE NOT bad AND k = tries) AS success, count(*) FILTER (WHERE bad OR k < tries) AS failures,
       CAST(coalesce(sum(k - 1) FILTER (WHERE NOT bad AND k = tries), 0) AS BIGINT) AS retry_attempts,
       count(*) FILTER (WHERE NOT bad AND k = tries AND k > 1) AS retry_events,
       CAST(coalesce(sum(k) FILTER (WHERE bad OR k < tries), 0) AS BIGINT) AS failure_attempts,
       41.5::DOUBLE AS util_min, 41.5::DOUBLE AS util_avg, 41.5::DOUBLE AS util_max, 512::DOUBLE AS max_memory,
       CAST(8192 AS BIGINT) AS memory_total, least(count(*), 24) * 41.5::DOUBLE AS util_sum,
       CAST(least(2 * count(*), 24) AS INTEGER) AS samples FROM e""",
    "stub_payload_files": f"""WITH {JOBS_SQL}
SELECT recording_id, chunk_id, start_ms AS chunk_start_ms,
       end_ms AS chunk_end_ms, 'none' AS label, 'stub' AS status, 'stub' AS runner,
       sha256 AS chunk_sha256 FROM jobs""",
    "report_bundle": f"""WITH {DETECTIONS_SQL},
l AS (SELECT count(*) AS n, avg(confidence) AS c,
             row_number() OVER (ORDER BY count(*) DESC, label NULLS FIRST, label_name NULLS FIRST) AS k
      FROM detections GROUP BY label, label_name),
r AS (SELECT count(*) AS n, avg(confidence) AS c, row_number() OVER (ORDER BY count(*) DESC, recording_id) AS k
      FROM detections GROUP BY recording_id),
c AS (SELECT count(*) AS n, avg(confidence) AS c FROM detections GROUP BY chunk_id),
t AS (SELECT CAST(sum(n) AS BIGINT) AS n, avg(c) AS c
      FROM (SELECT chunk_start_ms, count(*) AS n, avg(confidence) AS c FROM detections GROUP BY chunk_id, chunk_start_ms)
      GROUP BY coalesce(chunk_start_ms, 0) // 3600000),
e AS (
  SELECT 'quicklook_labels' AS export, n, c FROM l WHERE k <= 10
  UNION ALL SELECT 'quicklook_recordings', n, c FROM r WHERE k <= 5
  UNION ALL SELECT 'quicklook_chunks', n, c FROM c
  UNION ALL SELECT 'table_labels', n, c FROM l WHERE k <= 20
  UNION ALL SELECT 'table_recordings', n, c FROM r WHERE k <= 10
  UNION ALL SELECT 'table_timeline', n, c FROM t
  UNION ALL SELECT 'database_exports_label_summary', n, c FROM l WHERE k <= 15
  UNION ALL SELECT 'database_exports_recording_summary', n, c FROM r WHERE k <= 10
  UNION ALL SELECT 'database_exports_timeline', n, c FROM t
  UNION ALL SELECT 'view_labels', n, c FROM l
  UNION ALL SELECT 'view_recordings', n, c FROM r
  UNION ALL SELECT 'view_timeline', n, c FROM t)
SELECT export, count(*) AS rows, CAST(sum(n) AS BIGINT) AS detections, round(sum(c), 6) AS confidence_sum
FROM e GROUP BY export""",
}
