"""Manifests that still have to be scored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.sources.status import COMPLETED, MISSING, latest_status

# Default folders below a dataset root.
OUTPUT_DIR = "artifacts/infer"
TELEMETRY_DIR = "artifacts/telemetry"


def attach_status(plan: DataFrame, status: DataFrame) -> DataFrame:
    """Add the latest chunk status per recording (NULL where there is none)."""

    last = latest_status(status.select("recording_id", "updated_at", "status"))
    return plan.join(
        last.select("recording_id", F.col("status").alias("chunk_status")), "recording_id", "left"
    )


def build_infer_plan(
    manifests: DataFrame,
    outputs: DataFrame,
    status: DataFrame,
    saved_plan: DataFrame | None = None,
    output_dir: str = OUTPUT_DIR,
    telemetry_dir: str = TELEMETRY_DIR,
    include_existing: bool = False,
    detector_args: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Plans for manifests whose recording has no output yet.

    ``manifests`` (``recording_id, manifest_path``) are those that exist;
    ``saved_plan`` restricts and orders them. ``outputs`` lists finished recordings.
    """

    candidates = manifests.select("recording_id", "manifest_path")
    order = [F.col("manifest_path")]
    if saved_plan is not None:
        wanted = saved_plan.select("manifest_path", "plan_order")
        candidates = candidates.join(wanted, "manifest_path")
        order = [F.col("plan_order")]
    if not include_existing:
        candidates = candidates.join(outputs.select("recording_id"), "recording_id", "left_anti")
    if limit:
        candidates = candidates.orderBy(*order).limit(limit)
    plan = attach_status(candidates, status)
    output_dir, telemetry_dir = output_dir.rstrip("/"), telemetry_dir.rstrip("/")
    return plan.select(
        "recording_id",
        "manifest_path",
        F.lit(output_dir).alias("output_dir"),
        F.concat(F.lit(f"{output_dir}/"), "recording_id").alias("recording_output_dir"),
        F.concat(F.lit(f"{telemetry_dir}/infer/"), "recording_id", F.lit(".jsonl")).alias(
            "telemetry_log"
        ),
        F.array(*[F.lit(a) for a in detector_args]).cast("array<string>").alias("detector_args"),
        "chunk_status",
    )


def incomplete_plans(plan: DataFrame) -> DataFrame:
    """Plans whose windows are not known to be complete."""

    shown = F.coalesce("chunk_status", F.lit(MISSING))
    return plan.filter(shown != COMPLETED).select("recording_id", shown.alias("chunk_status"))


def require_complete(plan: DataFrame, allow_partial: bool = False) -> int:
    """Number of incomplete plans; an error unless partial work is allowed."""

    open_plans = incomplete_plans(plan).count()
    if open_plans and not allow_partial:
        raise RuntimeError(f"{open_plans} recording(s) are not completely cut into windows")
    return open_plans


def output_locations(plan: DataFrame, shown: int = 3) -> DataFrame:
    """The first few distinct output folders."""

    return plan.select("output_dir").distinct().orderBy("output_dir").limit(shown)
