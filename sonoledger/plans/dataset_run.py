"""Whole-dataset jobs: cutting, scoring, reporting."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonoledger.operators import reports as R
from sonoledger.operators.audio import cut_windows, export_wav_files, manifest_from_blobs
from sonoledger.operators.bundle import BundleOptions, write_bundle, write_recording_reports
from sonoledger.operators.ingest import enrich_payloads, explode_detections
from sonoledger.operators.score import (
    SCORED,
    ScoreOptions,
    even_partitions,
    event_rows,
    payload_rows,
    result_rows,
    score_windows,
)
from sonoledger.operators.telemetry import worker_totals
from sonoledger.operators.windows import plan_windows
from sonoledger.plans.chunk_plan import build_chunk_plan, runnable_plans
from sonoledger.plans.infer_plan import build_infer_plan, require_complete
from sonoledger.plans.resume import pending_jobs, resume_entries
from sonoledger.schemas import DETECTIONS, MANIFEST
from sonoledger.session import materialise
from sonoledger.sources._files import exists, subfolders
from sonoledger.sources._scan import nothing_there
from sonoledger.sources.detections import write_detections
from sonoledger.sources.recordings import discover_recordings, read_wav_headers
from sonoledger.sources.runs import write_job_results, write_worker_totals
from sonoledger.sources.status import COMPLETED, FAILED, IN_PROGRESS, append_status, read_status
from sonoledger.sources.tables import write_report_csv
from sonoledger.sources.telemetry import append_telemetry

# Windows cut per task: some megabytes each, so a lost task repeats little.
WINDOWS_PER_TASK = 256


class Layout(NamedTuple):
    """Where a dataset keeps its tables. All of them are shared folders."""

    root: str
    status: str
    manifest: str
    recordings: str
    blobs: str
    chunks: str
    scored: str
    results: str
    telemetry: str
    workers: str
    aggregate: str
    rollup: str
    worker_sums: str

    @classmethod
    def below(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(
            root=root,
            status=f"{root}/tables/chunk_status",
            manifest=f"{root}/tables/manifest",
            recordings=f"{root}/tables/recordings",
            blobs=f"{root}/tables/chunk_audio",
            chunks=f"{root}/artifacts/chunks",
            scored=f"{root}/tables/scored",
            results=f"{root}/tables/job_results",
            telemetry=f"{root}/artifacts/telemetry/infer",
            workers=f"{root}/artifacts/telemetry/workers",
            aggregate=f"{root}/artifacts/aggregate",
            rollup=f"{root}/tables/rollup",
            worker_sums=f"{root}/tables/worker_sums",
        )


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all runs under ``path`` with their ``run``; none before the first."""

    full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as exc:
        if nothing_there(exc):
            return spark.createDataFrame([], full)
        raise


def newest_run(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newest run per key; a repeated run replaces the earlier one."""

    newest = rows.groupBy(*keys).agg(F.max("run").alias("run"))
    return rows.join(newest, [*keys, "run"], "left_semi").select(*rows.columns)


def dataset_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The windows of each recording as last cut."""

    cuts = _runs(spark, Layout.below(root).manifest, MANIFEST)
    return newest_run(cuts, ["recording_id"]).drop("run")


def dataset_scores(spark: SparkSession, root: str) -> DataFrame:
    """All scored rows of all runs. Outcomes and detections both follow from these."""

    return _runs(spark, Layout.below(root).scored, SCORED)


def dataset_detections(spark: SparkSession, root: str) -> DataFrame:
    """Detections of the last successful score of every window."""

    good = dataset_scores(spark, root).filter(F.col("status") == "success")
    newest = newest_run(good, ["recording_id", "chunk_id"])
    return explode_detections(enrich_payloads(payload_rows(newest)))


def _finished_runs(path: str) -> set[str]:
    return {name for name in subfolders(path, "run=") if exists(f"{path}/{name}/_SUCCESS")}


def add_up_runs(spark: SparkSession, root: str) -> list[str]:
    """Reduce the scores of each new run to sums that add up over runs; the runs reduced.

    A run leaves the rollup of its detections, by window and label, and the totals of its
    workers. What was reduced before is not read again. The rollup is written last and
    marks a run as done, so a run whose reduction was cut short is reduced anew.
    """

    at = Layout.below(root)
    fresh = sorted(_finished_runs(at.scored) - _finished_runs(at.rollup))
    for run in fresh:
        scored = spark.read.schema(SCORED).parquet(f"{at.scored}/{run}")
        worker_totals(result_rows(scored)).write.mode("overwrite").parquet(f"{at.worker_sums}/{run}")
        found = explode_detections(enrich_payloads(payload_rows(scored.filter("status = 'success'"))))
        R.rollup(found).write.mode("overwrite").parquet(f"{at.rollup}/{run}")
    return fresh


def dataset_rollup(spark: SparkSession, root: str) -> DataFrame:
    """The rollup of :func:`dataset_detections` from the sums of runs; scores of new runs only are read."""

    add_up_runs(spark, root)
    at = Layout.below(root)
    runs = sorted(_finished_runs(at.rollup))
    if not runs:
        return R.rollup(spark.createDataFrame([], DETECTIONS))
    sums = spark.read.option("basePath", at.rollup).parquet(*[f"{at.rollup}/{run}" for run in runs])
    return newest_run(sums, ["recording_id", "chunk_id"]).drop("run")


def dataset_worker_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals per worker over all runs, from the sums of runs."""

    add_up_runs(spark, root)
    at = Layout.below(root)
    runs = sorted(_finished_runs(at.rollup))
    if not runs:
        return worker_totals(result_rows(dataset_scores(spark, root)))
    sums = spark.read.parquet(*[f"{at.worker_sums}/{run}" for run in runs])
    return sums.groupBy("worker").agg(*[F.sum(c).alias(c) for c in sums.columns if c != "worker"])


def cut_dataset(
    spark: SparkSession,
    root: str,
    chunk_duration: float = 60.0,
    overlap: float = 0.0,
    glob: str = "*.wav",
    include_existing: bool = False,
    limit: int | None = None,
    partitions: int | None = None,
    write_files: bool = True,
) -> DataFrame | None:
    """Cut every planned recording, in one job; returns the status rows of this run.

    Audio goes to the blob table and, with ``write_files``, to one WAV file per window
    at the manifest's ``source_path``, where detectors read it. Manifest rows follow from
    what was really written, and each recording ends as ``completed`` or ``failed`` with
    a row count. One unreadable recording fails alone. Recordings are told apart by their
    path: equal file names in different folders get ids of their own.
    """

    at = Layout.below(root)
    plan = runnable_plans(
        build_chunk_plan(
            discover_recordings(spark, root, glob),
            _runs(spark, at.manifest, MANIFEST).select("recording_id"),
            read_status(spark, at.status),
            root,
            chunk_duration,
            overlap,
            include_existing=include_existing,
            limit=limit,
        ),
        include_existing,
    ).drop("status", "has_manifest")
    started = datetime.now(timezone.utc)
    marks = plan.withColumns(
        {"status": F.lit(IN_PROGRESS), "started_at": F.lit(_now()), "updated_at": F.lit(_now())}
    )
    # The plan is fixed by writing it: from here on the job reads what it wrote.
    run_id = f"{started:%Y%m%dT%H%M%S%f}"
    append_status(marks, at.status)
    planned = read_status(spark, at.status).filter(
        (F.col("status") == IN_PROGRESS) & (F.col("started_at") >= started.isoformat())
    )
    if planned.isEmpty():
        return None

    facts = read_wav_headers(
        planned.select("recording_id", "audio_path", F.lit(None).cast("bigint").alias("length")),
        partitions,
    )
    blob_path = f"{at.blobs}/run={run_id}"
    fact_path = f"{at.recordings}/run={run_id}"
    facts.write.mode("overwrite").parquet(fact_path)
    facts = spark.read.parquet(fact_path)
    windows = plan_windows(
        facts.filter(F.col("error").isNull()), chunk_duration, overlap, at.chunks
    )
    tasks = partitions or even_partitions(windows, WINDOWS_PER_TASK)
    cut_windows(windows, tasks).write.mode("overwrite").parquet(blob_path)
    blobs = spark.read.parquet(blob_path)
    if write_files:
        export_wav_files(blobs).write.format("noop").mode("overwrite").save()
    manifest_from_blobs(blobs).write.mode("overwrite").parquet(f"{at.manifest}/run={run_id}")

    counts = blobs.groupBy("recording_id", "audio_path").agg(
        F.count_if(F.col("error").isNull()).alias("manifest_rows"),
        F.max("error").alias("window_error"),
    )
    error = F.coalesce("error", "window_error", F.when(F.col("n_frames") == 0, F.lit("no audio")))
    finished = _now()
    outcome = (
        planned.drop("status", "error", "manifest_rows", "updated_at", "completed_at", "duration_s")
        .join(facts.select("recording_id", "audio_path", "n_frames", "error"), ["recording_id", "audio_path"], "left")
        .join(counts, ["recording_id", "audio_path"], "left")
        .withColumn("error", error)
        .withColumns(
            {
                "status": F.when(F.col("error").isNull(), F.lit(COMPLETED)).otherwise(FAILED),
                "manifest_rows": F.coalesce("manifest_rows", F.lit(0)),
                "updated_at": F.lit(finished),
                "completed_at": F.lit(finished),
                "duration_s": F.lit((datetime.now(timezone.utc) - started).total_seconds()),
            }
        )
    )
    append_status(outcome, at.status)
    return read_status(spark, at.status).filter(
        (F.col("status") != IN_PROGRESS) & (F.col("completed_at") == finished)
    )


def score_dataset(
    spark: SparkSession,
    root: str,
    options: ScoreOptions = ScoreOptions(),
    allow_partial: bool = False,
    resume: bool = True,
    include_existing: bool = False,
) -> DataFrame | None:
    """Score every window still open; returns the outcome rows of this run.

    The scored table is the one record of a run: what is still open, and later
    the detections, are read from it. Telemetry, outcome and worker exports
    follow, so a stop in between leaves no window scored but unaccounted for.
    """

    at = Layout.below(root)
    manifest = dataset_manifest(spark, root)
    done = result_rows(dataset_scores(spark, root))
    listed = manifest.select("recording_id").distinct().withColumn(
        "manifest_path", F.concat(F.lit(f"{at.root}/manifests/"), "recording_id", F.lit(".csv"))
    )
    plan = build_infer_plan(
        listed,
        done.select("recording_id").distinct(),
        read_status(spark, at.status),
        # With resume the windows decide, not whether the recording has any output.
        include_existing=include_existing or resume,
    )
    require_complete(plan, allow_partial)
    jobs = manifest.join(plan.select("recording_id"), "recording_id", "left_semi")
    if resume and not include_existing:
        jobs = pending_jobs(jobs, resume_entries(done))
    # Fixed by writing it: it is counted, dealt out and scored.
    jobs = materialise(jobs.select(*MANIFEST.names), "jobs")
    if jobs.isEmpty():
        return None
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    score_windows(jobs, options).write.mode("overwrite").parquet(f"{at.scored}/run={run}")
    scored = spark.read.schema(SCORED).parquet(f"{at.scored}/run={run}")
    append_telemetry(event_rows(scored), at.telemetry)
    outcomes = result_rows(scored)
    write_job_results(outcomes, at.results)
    write_worker_totals(dataset_worker_totals(spark, root), at.workers)
    return outcomes


def run_dataset(
    spark: SparkSession,
    root: str,
    chunk_duration: float = 60.0,
    overlap: float = 0.0,
    options: ScoreOptions = ScoreOptions(),
    bundle: BundleOptions | None = BundleOptions(),
    rollup_limit: int = 20,
    run_name: str = "dataset",
) -> dict[str, str]:
    """Cut, score, bundle and roll up a dataset; returns where the reports are.

    Reports follow from the sums of runs (:func:`dataset_rollup`); a further run adds its
    own. Only the export of all detections and the stored table are written whole.
    """

    at = Layout.below(root)
    cut_dataset(spark, root, chunk_duration, overlap)
    score_dataset(spark, root, options, allow_partial=True)
    table = f"{at.aggregate}/all_detections.parquet"
    write_detections(dataset_detections(spark, root), table, clustered=True)
    detections = spark.read.schema(DETECTIONS).parquet(table)
    rolled = materialise(dataset_rollup(spark, root), "rollup")
    written = {}
    if bundle is not None:
        written = write_bundle(detections, at.aggregate, run_name, bundle, rolled=rolled)
        folder = f"{at.aggregate}/{run_name}_recordings"
        write_recording_reports(rolled, folder, bundle)
        written["recordings"] = folder
    labels, recordings, _ = R.folder_rollup(rolled, rollup_limit)
    folder = f"{at.aggregate}/aggregate_summary"
    write_report_csv(labels, f"{folder}/label_summary.csv")
    write_report_csv(recordings, f"{folder}/recording_summary.csv")
    return {**written, "rollup": folder}
