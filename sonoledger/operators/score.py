"""Running a detector over windows as a Spark job."""

from __future__ import annotations

import csv
import json
import shlex
import socket
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path
from typing import Any, NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonoledger.schemas import DEVICE_METRICS, JOB_RESULTS, MANIFEST
from sonoledger.sources import _files
from sonoledger.sources.labels import LABEL_FILE_NAME

# A detector takes one manifest row and returns its detections, or a :class:`Found`.
Detector = Callable[[dict[str, Any]], "Sequence[dict[str, Any]] | Found"]
# The same for many rows in one call, for models that want batches.
BatchDetector = Callable[[list[dict[str, Any]]], "Sequence[Sequence[dict[str, Any]] | Found]"]
# Measures the device of a task (its index, NULL for a processor) before and after each attempt.
Sampler = Callable[[int | None], "dict[str, Any] | None"]


class Found(NamedTuple):
    """Detections with what a detector tells beside them."""

    detections: Sequence[dict[str, Any]]
    status: str | None = None
    output: str | None = None
    stdout: str | None = None


class DetectorFailed(RuntimeError):
    """A detector process that ended badly."""

    def __init__(self, text: str, returncode: int, stdout: str | None = None) -> None:
        super().__init__(text)
        self.returncode, self.stdout = returncode, stdout

    def __reduce__(self):
        return DetectorFailed, (self.args[0], self.returncode, self.stdout)


# Fixed values.
MAX_RETRIES = 2
BACKOFF_LIMIT_S = 5
STUB, CUSTOM = "stub", "custom"
FILES_PER_RECORDING = 4
PAYLOADS_PER_FILE = 100_000
DETECTOR_TABLE = "hawkears"  # of a run configuration, holding the detector's extra_args
DETECTOR = "hawkears"  # runner name of a detector that leaves a label file
RAW_OUTPUT_SUFFIX = "_hawkears"  # of the folder it writes to

_DETECTION = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("timestamp_ms", "end_ms")],
        *[T.StructField(n, T.StringType()) for n in ("label", "label_code", "label_name")],
        T.StructField("confidence", T.DoubleType()),
    ]
)
_EVENT = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("status", "timestamp", "finished_at")],
        T.StructField("runtime_s", T.DoubleType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("backoff_s", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("stdout", T.StringType()),
        T.StructField("returncode", T.LongType()),
        T.StructField("gpu_name", T.StringType()),
        *[T.StructField(n, DEVICE_METRICS) for n in ("before", "after")],
    ]
)
# A scored window: its manifest row, the outcome, and what happened on the way.
SCORED = T.StructType(
    [
        *MANIFEST,
        T.StructField("status", T.StringType()),
        *[T.StructField(n, T.IntegerType()) for n in ("attempts", "retries")],
        T.StructField("last_backoff_s", T.DoubleType()),
        *[T.StructField(n, T.StringType()) for n in ("last_error", "worker", "runner")],
        T.StructField("model_version", T.StringType()),
        T.StructField("gpu_index", T.LongType()),
        T.StructField("payload_status", T.StringType()),
        T.StructField("detections", T.ArrayType(_DETECTION)),
        T.StructField("events", T.ArrayType(_EVENT)),
    ]
)


@dataclass(frozen=True)
class ScoreOptions:
    """Options of a scoring run."""

    detector: Detector | None = None
    batch_detector: BatchDetector | None = None
    batch_size: int = 64
    sampler: Sampler | None = None
    command: str | None = None
    label_files: bool = False  # the command writes a label file into a folder
    output_dir: str | None = None
    max_retries: int = MAX_RETRIES
    backoff_limit_s: float = BACKOFF_LIMIT_S
    windows_per_task: int = 128
    partitions: int | None = None
    fail_fast: bool = False
    model_version: str | None = None
    extra_args: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if sum(d is not None for d in (self.detector, self.batch_detector, self.command)) > 1:
            raise ValueError("give either a detector or a command, not both")
        if self.batch_size < 1:
            raise ValueError("batch_size must be positive")
        if self.command is not None and self.output_dir is None:
            raise ValueError("a command needs an output_dir that all executors reach")
        if self.max_retries < 0 or self.backoff_limit_s < 0:
            raise ValueError("max_retries and backoff_limit_s cannot be negative")
        if not all(isinstance(a, str) for a in self.extra_args):
            raise ValueError("extra_args must be text")

    @property
    def runner(self) -> str:
        if self.detector is self.batch_detector is self.command is None:
            return STUB
        return DETECTOR if self.command is not None and self.label_files else CUSTOM

    @classmethod
    def from_mapping(
        cls, config: dict[str, Any], detector_table: str = DETECTOR_TABLE
    ) -> tuple[str, ScoreOptions]:
        """``(manifest, options)`` from a parsed run configuration.

        The ``runner`` table must name a manifest; the detector's own table may
        hold ``extra_args``.
        """

        runner = config.get("runner") or {}
        if not isinstance(runner, dict) or not runner.get("manifest"):
            raise ValueError("a [runner] table with a manifest is required")
        own = config.get(detector_table) or {}
        args = own.get("extra_args", []) if isinstance(own, dict) else []
        if not isinstance(args, list) or not all(isinstance(a, str) for a in args):
            raise ValueError("extra_args must be a list of texts")
        return runner["manifest"], cls(
            command=runner.get("runner_cmd"),
            output_dir=runner.get("output_dir"),
            max_retries=int(runner.get("max_retries", MAX_RETRIES)),
            extra_args=tuple(args),
        )


def _attempt_folder(output_dir: str) -> tempfile.TemporaryDirectory:
    """A folder that one attempt writes to and that goes with it.

    It lies in ``output_dir`` where that is mounted. A command can only write to mounted folders,
    so for other filesystems it is the executor's own scratch, held for the one call.
    """

    if "://" in output_dir and not output_dir.startswith("file://"):
        return tempfile.TemporaryDirectory()
    base = Path(output_dir.removeprefix("file://").removeprefix("file:"))
    base.mkdir(parents=True, exist_ok=True)
    return tempfile.TemporaryDirectory(prefix=".attempt-", dir=base)


def command_detector(
    command: str, output_dir: str, extra_args: Sequence[str] = ()
) -> Detector:
    """A detector that runs ``command --input X --output Y`` per window.

    Y is a file of the attempt. If the command succeeds and writes Y, it is moved whole to
    ``output_dir``/recording/window.json, on any filesystem Arrow knows, so a lost or failed
    attempt leaves no half file. If Y holds an object its ``detections`` are taken; an exit
    code other than zero counts as a failed attempt.
    """

    base = [*shlex.split(command), *extra_args]

    def detect(job: dict[str, Any]) -> Sequence[dict[str, Any]]:
        target = f"{output_dir.rstrip('/')}/{job['recording_id']}/{job['chunk_id']}.json"
        with _attempt_folder(output_dir) as scratch:
            draft = Path(scratch) / f"{job['chunk_id']}.json"
            stdout = _run([*base, "--input", str(job["source_path"]), "--output", str(draft)])
            if not draft.exists():
                _files.remove(target)  # of an earlier run
                return Found([], None, target, stdout)
            rows = json.loads(draft.read_text()).get("detections") or []
            with draft.open("rb") as content:
                _files.publish(target, content)
        return Found(rows, None, target, stdout)

    return detect


def _run(command: list[str]) -> str:
    done = subprocess.run(command, capture_output=True, text=True, check=False)
    if done.returncode:
        text = done.stderr or done.stdout or f"exit code {done.returncode}"
        raise DetectorFailed(text, done.returncode, done.stdout)
    return done.stdout


def label_file_detector(
    command: str, output_dir: str, extra_args: Sequence[str] = (), label_file: str = LABEL_FILE_NAME
) -> Detector:
    """A detector that runs ``command -i X -o FOLDER`` and leaves ``label_file`` there.

    Rows of the window's own file name, and rows without one, are its detections. The
    status is ``ok``, ``no_detections`` (a file without such rows) or ``no_output``. FOLDER
    belongs to the attempt; what a successful one leaves there is moved file by file to a
    folder of the window in ``output_dir``, on any filesystem Arrow knows, ``label_file`` last.
    """

    base = [*shlex.split(command), *extra_args]

    def detect(job: dict[str, Any]) -> Found:
        target = f"{output_dir.rstrip('/')}/{job['recording_id']}/{job['chunk_id']}{RAW_OUTPUT_SUFFIX}"
        name = Path(str(job["source_path"])).name
        with _attempt_folder(output_dir) as scratch:
            folder = Path(scratch)
            stdout = _run([*base, "-i", str(job["source_path"]), "-o", str(folder)])
            labels = folder / label_file
            rows, status = [], "no_output"
            if labels.exists():
                with labels.open(newline="") as lines:
                    rows = [r for r in csv.DictReader(lines) if Path(r.get("filename") or "").name in ("", name)]
                status = "ok" if rows else "no_detections"
            else:
                _files.remove(f"{target}/{label_file}")  # of an earlier run
            left = sorted(f for f in folder.rglob("*") if f.is_file())
            for file in sorted(left, key=lambda f: f == labels):
                with file.open("rb") as content:
                    _files.publish(f"{target}/{file.relative_to(folder).as_posix()}", content)
        return Found([_label_row(r) for r in rows], status, target, stdout)

    return detect


def _label_row(row: dict[str, str]) -> dict[str, Any]:
    code, name = row.get("class_code") or None, row.get("class_name") or None

    def ms(text: str | None) -> int | None:
        try:
            return int(float(text) * 1000) if text else None
        except ValueError:
            return None

    return {
        "timestamp_ms": ms(row.get("start_time")), "end_ms": ms(row.get("end_time")),
        "label": code or name or "unknown", "label_code": code, "label_name": name,
        "confidence": float(row["score"]) if row.get("score") else None,
    }


def _stub(job: dict[str, Any]) -> Sequence[dict[str, Any]]:
    return []


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def nvidia_sampler(index: int | None) -> dict[str, Any] | None:
    """Utilisation and memory of a device as its driver tells them; nothing for a processor."""

    if index is None:
        return None
    # Fields of the driver's query.
    fields = ["name", "utilization.gpu", "memory.used", "memory.total"]
    done = subprocess.run(
        ["nvidia-smi", f"--id={index}", f"--query-gpu={','.join(fields)}", "--format=csv,noheader,nounits"],
        capture_output=True, text=True, check=False,
    )
    cells = [c.strip() for c in done.stdout.strip().rsplit(",", len(fields) - 1)]
    if done.returncode or len(cells) != len(fields):
        return None

    def number(text: str) -> float | None:
        return float(text) if text.replace(".", "", 1).isdigit() else None

    return {
        "name": cells[0], "index": index, "utilization": number(cells[1]), "memory_used_mb": number(cells[2]),
        "memory_total_mb": number(cells[3]),
    }


def _sample(sampler: Sampler | None, gpu: int | None) -> dict[str, Any]:
    """One measurement; a device that cannot be measured never fails a window."""

    try:
        return (sampler(gpu) if sampler else None) or {}
    except Exception:
        return {}


def _metrics(sample: dict[str, Any]) -> dict[str, Any] | None:
    held = {n: sample.get(n) for n in DEVICE_METRICS.names}
    if all(v is None for v in held.values()):
        return None
    return {n: None if v is None else int(v) if n == "index" else float(v) for n, v in held.items()}


def score_windows(manifest: DataFrame, options: ScoreOptions = ScoreOptions()) -> DataFrame:
    """One row per window: outcome, detections and the events of every attempt.

    Rows are dealt out evenly whatever recording they come from, since the work
    is per window. A window that fails all attempts is a ``failure`` row, not a
    failed job, unless ``fail_fast``. The result should be written before it is
    used twice: reading it again would run the detector again.

    A batch that fails is halved, and its halves are tried, until the windows that fail
    by themselves are found; the others succeed in the same attempt. Only those found
    wait and are tried again, together. A window's run time is that of the call that
    settled it, divided by the windows of the call; windows of one call share its
    clock and the measurements around it.
    """

    of_command = label_file_detector if options.label_files else command_detector
    detect = options.detector or (
        of_command(options.command, options.output_dir, options.extra_args) if options.command else _stub
    )
    many, sampler, limit = options.batch_detector, options.sampler, options.backoff_limit_s
    tries, fail_fast, succeeded = options.max_retries + 1, options.fail_fast, "success"
    runner, model_version = options.runner, options.model_version
    size = options.batch_size if many else 1

    def call(jobs: list[dict[str, Any]]) -> list[Found]:
        found = list(many(jobs)) if many else [detect(jobs[0])]
        if len(found) != len(jobs):
            raise ValueError(f"{len(found)} results for {len(jobs)} windows")
        found = [f if isinstance(f, Found) else Found(f) for f in found]
        return [f._replace(detections=[dict(d) for d in f.detections]) for f in found]

    def settle(jobs: list[dict[str, Any]], gpu: int | None) -> list[tuple[Found | Exception, dict[str, Any]]]:
        """Result or error of each window with the end of its event, by halving calls that fail."""

        before, began = _sample(sampler, gpu), time.monotonic()
        try:
            found: list[Found | Exception] = list(call(jobs))
        except Exception as exc:
            if len(jobs) > 1:
                half = len(jobs) // 2
                return settle(jobs[:half], gpu) + settle(jobs[half:], gpu)
            found = [exc]
        runtime = (time.monotonic() - began) / len(jobs)
        after = _sample(sampler, gpu)
        end = dict(finished_at=_now(), runtime_s=runtime, gpu_name=after.get("name") or before.get("name"),
                   before=_metrics(before), after=_metrics(after))
        return [(f, end) for f in found]

    def attempt_all(jobs: list[dict[str, Any]], gpu: int | None) -> list[dict[str, Any]]:
        """Outcomes of some windows that are first tried in one call."""

        held = [dict(status="failure", attempts=0, detections=[], payload_status=None, events=[],
                     last_backoff_s=None, last_error=None) for _ in jobs]
        open_ = list(range(len(jobs)))
        for attempt in range(1, tries + 1):
            started, failed = _now(), []
            backoff = float(min(2**attempt, limit))
            for n, (found, end) in zip(open_, settle([jobs[n] for n in open_], gpu)):
                mine = held[n]
                mine["attempts"] = attempt
                event = dict(timestamp=_now(), attempt=attempt, **end)
                mine["events"].append(dict(status="start", timestamp=started, attempt=attempt))
                if isinstance(found, Found):
                    mine["events"].append(dict(event, status=succeeded, output=found.output, stdout=found.stdout))
                    mine.update(status=succeeded, detections=found.detections, payload_status=found.status)
                    continue
                if fail_fast and attempt == tries:
                    raise found
                mine.update(last_backoff_s=backoff, last_error=str(found) or type(found).__name__)
                mine["events"].append(
                    dict(event, status="failure", backoff_s=backoff, error=mine["last_error"],
                         returncode=getattr(found, "returncode", None), stdout=getattr(found, "stdout", None))
                )
                failed.append(n)
            open_ = failed
            if not open_:
                break
            if attempt < tries:
                time.sleep(backoff)
        return held

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        gpus = task.resources().get("gpu") if task else None
        gpu = int(gpus.addresses[0]) if gpus and gpus.addresses[0].isdigit() else None
        # A worker is a device or a machine, as many as the cluster has, whatever the data.
        host = socket.gethostname()
        worker = f"{host}-gpu-{gpu}" if gpu is not None else f"cpu-{host}"
        for batch in batches:
            out, jobs = [], batch.astype(object).where(batch.notna(), None).to_dict("records")
            for at in range(0, len(jobs), size):
                part = jobs[at : at + size]
                for job, outcome in zip(part, attempt_all(part, gpu)):
                    out.append({**job, **outcome, "retries": outcome["attempts"] - 1,
                                "worker": worker, "runner": runner,
                                "model_version": model_version, "gpu_index": gpu})
            yield pd.DataFrame(out)

    jobs = manifest.select(*MANIFEST.names)
    parts = options.partitions or even_partitions(jobs, options.windows_per_task)
    return jobs.repartition(parts).mapInPandas(run, SCORED)


def even_partitions(jobs: DataFrame, per_task: int) -> int:
    """Enough tasks for the given share each, and all cores for short runs."""

    rows, cores = jobs.count(), jobs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-rows // per_task), min(rows, cores))


def payload_rows(scored: DataFrame) -> DataFrame:
    """Successful windows in the shape :func:`ingest.enrich_payloads` takes."""

    status = F.when(F.col("runner") == STUB, F.lit(STUB)).otherwise(F.coalesce("payload_status", F.lit("ok")))
    return scored.filter(F.col("status") == "success").select(
        F.col("source_path").alias("file_path"),
        "chunk_id",
        "recording_id",
        F.col("recording_id").alias("parent_dir"),
        "source_path",
        status.alias("status"),
        "runner",
        F.lit(None).cast("string").alias("dataset_root"),
        "model_version",
        F.col("start_ms").alias("chunk_start_ms"),
        F.col("end_ms").alias("chunk_end_ms"),
        F.col("sha256").alias("chunk_sha256"),
        F.lit(None).cast("string").alias("label_dir"),
        "detections",
    )


def event_rows(scored: DataFrame) -> DataFrame:
    """Telemetry events of a run, ready to append to the log."""

    event = F.col("event")
    measured = F.filter(
        F.transform("events", lambda e: F.coalesce(e["before"]["index"], e["after"]["index"])), lambda i: i.isNotNull()
    )
    # Without a device of the task, the one that was measured counts for all events of a window.
    device = F.coalesce("gpu_index", F.get(measured, F.lit(0))).alias("gpu_index")
    return scored.select("chunk_id", device, "runner", F.explode("events").alias("event")).select(
        "chunk_id",
        "gpu_index",
        event["gpu_name"].alias("gpu_name"),
        event["status"].alias("status"),
        event["timestamp"].alias("timestamp"),
        event["finished_at"].alias("finished_at"),
        event["runtime_s"].alias("runtime_s"),
        F.struct(
            event["attempt"].cast("double").alias("attempt"),
            event["output"].alias("output"),
            F.col("runner").alias("runner"),
            event["stdout"].alias("stdout"),
            event["error"].alias("stderr"),
            event["returncode"].alias("returncode"),
            event["backoff_s"].alias("backoff_s"),
            F.when(
                F.coalesce("event.before", "event.after").isNotNull(),
                F.struct(event["before"].alias("before"), event["after"].alias("after")),
            ).alias("gpu_metrics"),
        ).alias("details"),
    )


def result_rows(scored: DataFrame) -> DataFrame:
    """One outcome row per window, as the run table stores it."""

    failed = F.col("status") != "success"
    return scored.withColumns(
        {
            "output": F.when(~failed, F.concat_ws("/", "recording_id", "chunk_id")),
            "error": F.when(
                failed,
                F.concat(F.lit("failed after "), F.col("attempts").cast("string"), F.lit(" attempt(s)")),
            ),
            "retries": F.when(~failed, F.col("retries")),
        }
    ).select(*JOB_RESULTS.names)


def write_payload_json(scored: DataFrame, path: str, per_file: int = PAYLOADS_PER_FILE) -> str:
    """Payloads in their interchange shape, many per file, those of a recording side by side.

    Recordings share files: their number follows the rows, not the recordings, of which there
    may be millions. Each payload names its recording.
    """

    rows = payload_rows(scored).select(
        "chunk_id", "recording_id", "source_path", "status", "runner", "model_version", "detections",
        F.struct(
            F.col("chunk_start_ms").alias("start_ms"),
            F.col("chunk_end_ms").alias("end_ms"),
            F.col("chunk_sha256").alias("sha256"),
        ).alias("chunk"),
    )
    # Windows of a recording meet in a few tasks, however many it has.
    salt = F.pmod(F.xxhash64("chunk_id"), F.lit(FILES_PER_RECORDING))
    ordered = rows.repartition("recording_id", salt).sortWithinPartitions("recording_id", "chunk_id")
    ordered.write.mode("append").option("maxRecordsPerFile", per_file).json(path)
    return path


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """Payloads packed many to a file, one JSON object per line."""

    from sonoledger.sources._scan import scan_path
    from sonoledger.sources.payloads import parse_payloads

    lines = spark.read.text(path, recursiveFileLookup=True)
    return parse_payloads(lines.select(scan_path().alias("file_path"), "value"))
