"""The test tables seen as recordings, windows, detections and events.

Every proxy keeps all rows of its table. Remainders only vary the values, so
that blank names, missing starts and the like occur; they never drop rows. Each
proxy comes with the SQL that DuckDB uses for the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.operators.audio import export_wav_files
from sonoledger.operators.score import even_partitions
from sonoledger.schemas import TELEMETRY

# Creating a small file is a round trip, so a task gets no more of them however many there are.
FILES_PER_TASK = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_files(files: DataFrame, per_task: int = FILES_PER_TASK) -> int:
    """Write ``content`` to ``source_path`` for every row; the tasks that did it.

    The share of a task is set by the rows: left to their bytes, a table of small texts
    is one task's work.
    """

    tasks = even_partitions(files, per_task)
    export_wav_files(files.repartition(tasks)).write.format("noop").mode("overwrite").save()
    return tasks


# ---- detections ------------------------------------------------------------------------

_MS = (
    "(unix_micros(cast(ts AS timestamp))"
    " - unix_micros(cast(timestamp_ntz '2024-01-01 00:00:00' AS timestamp))) div 1000"
)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 columns from ``events``: one window per user and minute."""

    timed = table(spark, sf_dir, "events").withColumn("ms", F.expr(_MS))
    return timed.selectExpr(
        "concat('rec_', user_id) AS recording_id",
        "concat('rec_', user_id, '_chunk_', ms div 60000 * 60000) AS chunk_id",
        "if(event_id % 50 = 0, NULL, ms div 60000 * 60000) AS chunk_start_ms",
        "ms div 60000 * 60000 + 60000 AS chunk_end_ms",
        "if(event_id % 11 = 0, NULL, ms % 60000) AS timestamp_ms",
        "if(event_id % 11 = 0, NULL, ms) AS absolute_time_ms",
        "if(event_id % 11 = 0, NULL, ms % 60000 + 900) AS end_ms",
        "if(event_id % 11 = 0, NULL, ms + 900) AS absolute_end_ms",
        "if(event_id % 11 = 0, 'none', event_type) AS label",
        "upper(substr(event_type, 1, 4)) AS label_code",
        "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE upper(event_type) END AS label_name",
        "if(event_id % 11 = 0, NULL, value) AS confidence",
        "if(event_id % 11 = 0, 'unknown', 'ok') AS status",
        "'custom' AS runner",
        "cast(NULL AS string) AS model_version",
        "cast(NULL AS string) AS chunk_sha256",
        "concat('/data/set_', user_id % 5, '/audio/rec_', user_id, '.wav') AS source_path",
        "cast(NULL AS string) AS dataset_root",
    )


DETECTIONS_SQL = """
timed AS (
  SELECT *, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000 AS ms FROM events
),
detections AS (
  SELECT 'rec_' || user_id AS recording_id,
         'rec_' || user_id || '_chunk_' || (ms // 60000 * 60000) AS chunk_id,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE ms // 60000 * 60000 END AS chunk_start_ms,
         ms // 60000 * 60000 + 60000 AS chunk_end_ms,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE ms % 60000 END AS timestamp_ms,
         CASE WHEN event_id % 11 = 0 THEN 'none' ELSE event_type END AS label,
         CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE upper(event_type) END AS label_name,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS confidence,
         '/data/set_' || (user_id % 5) || '/audio/rec_' || user_id || '.wav' AS source_path
  FROM timed
)
"""

# ---- telemetry -------------------------------------------------------------------------


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scoring telemetry: four devices and a CPU, one log in id order."""

    events = table(spark, sf_dir, "events").withColumn(
        "k", F.expr("cast(get_json_object(props, '$.k') AS bigint)")
    )
    metrics = (
        "named_struct('index', user_id % 5, 'utilization', cast(k AS double),"
        " 'memory_used_mb', if(k % 4 = 0, NULL, cast(5000 + k AS double)),"
        " 'memory_total_mb', cast(8192 AS double))"
    )
    rows = events.selectExpr(
        "concat('chunk_', event_id) AS chunk_id",
        "if(user_id % 5 = 4, NULL, user_id % 5) AS gpu_index",
        "if(k % 3 = 0, '', concat('Model ', user_id % 5)) AS gpu_name",
        "CASE event_type WHEN 'error' THEN 'failure' WHEN 'view' THEN 'start'"
        " ELSE 'SUCCESS' END AS status",
        "if(k % 10 = 0, '', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")) AS timestamp",
        "cast(NULL AS string) AS finished_at",
        "if(event_type = 'view', NULL, value / 10) AS runtime_s",
        "named_struct('attempt', if(k % 6 = 0, NULL, cast(k % 3 + 1 AS double)),"
        " 'output', cast(NULL AS string), 'runner', 'custom', 'stdout', cast(NULL AS string),"
        " 'stderr', cast(NULL AS string), 'returncode', cast(NULL AS bigint),"
        " 'backoff_s', cast(NULL AS double),"
        f" 'gpu_metrics', if(k % 5 = 0, NULL, named_struct('before', {metrics},"
        f" 'after', if(k % 2 = 0, NULL, {metrics})))) AS details",
        "named_struct('file', 'log', 'block', 0L, 'row', event_id) AS event_order",
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TELEMETRY])


TELEMETRY_SQL = """
raw AS (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events),
flat AS (
  SELECT event_id,
         'chunk_' || event_id AS chunk_id,
         CASE WHEN user_id % 5 = 4 THEN 'CPU' ELSE 'GPU ' || (user_id % 5) END AS device,
         CASE WHEN k % 3 = 0 THEN NULL ELSE 'Model ' || (user_id % 5) END AS gpu_name,
         CASE event_type WHEN 'error' THEN 'failure' WHEN 'view' THEN 'start'
              ELSE 'SUCCESS' END AS status,
         CASE WHEN k % 10 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp,
         CASE WHEN event_type = 'view' THEN NULL ELSE value / 10 END AS runtime_s,
         CASE WHEN k % 6 = 0 THEN NULL ELSE k % 3 + 1 END AS attempt_raw,
         CASE WHEN k % 6 = 0 THEN 1 ELSE k % 3 + 1 END AS attempt,
         CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS util,
         CASE WHEN k % 5 = 0 OR k % 4 = 0 THEN NULL ELSE 5000 + k END AS mem,
         CASE WHEN k % 5 = 0 THEN NULL ELSE 8192 END AS mem_total
  FROM raw
)
"""

# ---- recordings, manifests, jobs, status -----------------------------------------------


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as recordings: one frame per character, ten frames a second."""

    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "concat('rec_', doc_id) AS recording_id",
        "concat('/data/', source, '/audio/', lang, '/rec_', doc_id, '.wav') AS audio_path",
        "cast(10 AS int) AS sample_rate",
        "cast(n_chars AS bigint) AS n_frames",
        "n_chars / 10 AS duration_s",
        "cast(1 + doc_id % 2 AS int) AS channels",
        "cast(2 AS int) AS sample_width_bytes",
    )


RECORDINGS_SQL = """
recordings AS (
  SELECT doc_id, 'rec_' || doc_id AS recording_id,
         '/data/' || source || '/audio/' || lang || '/rec_' || doc_id || '.wav' AS audio_path,
         10 AS sample_rate, n_chars AS n_frames, n_chars / 10 AS duration_s,
         1 + doc_id % 2 AS channels, 2 AS sample_width_bytes
  FROM documents
)
"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as windows to score: one recording per customer."""

    return table(spark, sf_dir, "orders").selectExpr(
        "concat('rec_', o_custkey) AS recording_id",
        "concat('chunk_', o_orderkey) AS chunk_id",
        "concat('/audio/rec_', o_custkey, '/chunk_', o_orderkey, '.wav') AS source_path",
        "o_orderkey * 60000 AS start_ms",
        "o_orderkey * 60000 + 60000 AS end_ms",
        "0L AS overlap_ms",
        "if(o_orderkey % 3 = 0, NULL, concat('sha', o_orderkey)) AS sha256",
        "cast(NULL AS string) AS notes",
        "o_orderkey",
        "o_orderstatus",
        "o_orderdate",
        "o_totalprice",
    )


JOBS_SQL = """
jobs AS (
  SELECT 'rec_' || o_custkey AS recording_id, 'chunk_' || o_orderkey AS chunk_id,
         '/audio/rec_' || o_custkey || '/chunk_' || o_orderkey || '.wav' AS source_path,
         o_orderkey * 60000 AS start_ms, o_orderkey * 60000 + 60000 AS end_ms,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'sha' || o_orderkey END AS sha256,
         o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice
  FROM orders
)
"""


def job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order outcomes as run results: workers by priority, retries by price."""

    return table(spark, sf_dir, "orders").selectExpr(
        "concat('chunk_', o_orderkey) AS chunk_id",
        "if(o_orderkey % 5 = 0, NULL, concat('rec_', o_custkey)) AS recording_id",
        "if(o_orderstatus = 'F', 'success', 'failure') AS status",
        "cast(1 + cast(o_totalprice AS bigint) % 4 AS int) AS attempts",
        "if(o_orderstatus = 'F', cast(cast(o_totalprice AS bigint) % 4 AS int), NULL) AS retries",
        "cast(NULL AS string) AS output",
        "concat('gpu-', substr(o_orderpriority, 1, 1)) AS worker",
        "cast(NULL AS double) AS last_backoff_s",
        "cast(NULL AS string) AS last_error",
        "cast(NULL AS string) AS error",
    )


JOB_RESULTS_SQL = """
job_results AS (
  SELECT 'chunk_' || o_orderkey AS chunk_id,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'rec_' || o_custkey END AS recording_id,
         CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failure' END AS status,
         1 + CAST(trunc(o_totalprice) AS BIGINT) % 4 AS attempts,
         CASE WHEN o_orderstatus = 'F' THEN CAST(trunc(o_totalprice) AS BIGINT) % 4 END AS retries,
         'gpu-' || substr(o_orderpriority, 1, 1) AS worker
  FROM orders
)
"""


def status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as a status log: many rows per customer, the newest counts."""

    return table(spark, sf_dir, "orders").selectExpr(
        "concat('rec_', o_custkey) AS recording_id",
        "concat('/data/audio/rec_', o_custkey, '.wav') AS audio_path",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), '#', lpad(o_orderkey, 12, '0'))"
        " AS updated_at",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed'"
        " ELSE 'in_progress' END AS status",
        "o_orderkey AS manifest_rows",
    )


STATUS_SQL = """
status_rows AS (
  SELECT 'rec_' || o_custkey AS recording_id,
         strftime(o_orderdate, '%Y-%m-%d') || '#' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
           AS updated_at,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed'
              ELSE 'in_progress' END AS status,
         o_orderkey AS manifest_rows
  FROM orders
),
latest AS (
  SELECT recording_id, arg_max(status, updated_at) AS status, max(updated_at) AS updated_at,
         arg_max(manifest_rows, updated_at) AS manifest_rows
  FROM status_rows GROUP BY recording_id
)
"""


def customer_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as recordings; some never had a status."""

    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "concat('rec_', c_custkey) AS recording_id",
        "concat('/data/audio/', lower(c_mktsegment), '/rec_', c_custkey, '.wav') AS audio_path",
    )


CUSTOMER_SQL = """
customers AS (
  SELECT c_custkey, 'rec_' || c_custkey AS recording_id,
         '/data/audio/' || lower(c_mktsegment) || '/rec_' || c_custkey || '.wav' AS audio_path
  FROM customer
)
"""
