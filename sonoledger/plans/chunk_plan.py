"""Recordings that still have to be cut into windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import posix_path, stem
from sonoledger.sources.status import COMPLETED, FAILED, IN_PROGRESS, latest_status

# Default folders below a dataset root.
MANIFEST_DIR = "manifests"
CHUNKS_DIR = "artifacts/chunks"


def resolve(base: str, path: str) -> str:
    return path if path.startswith("/") or "://" in path else f"{base.rstrip('/')}/{path}"


def needs_resume(status: str = "status") -> Column:
    """A recording whose last job did not finish."""

    return F.coalesce(F.col(status).isin(FAILED, IN_PROGRESS), F.lit(False))


def list_manifests(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Manifest files below a folder, from the listing alone."""

    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    path = posix_path("path")
    return files.select(stem(path).alias("recording_id"), path.alias("manifest_path"))


def build_chunk_plan(
    recordings: DataFrame,
    manifests: DataFrame,
    status: DataFrame,
    dataset_root: str = "",
    chunk_duration: float = 60.0,
    overlap: float = 0.0,
    manifest_dir: str = MANIFEST_DIR,
    chunks_dir: str = CHUNKS_DIR,
    include_existing: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Plans for recordings without a manifest or with an unfinished last job.

    ``manifests`` needs ``recording_id``; a manifest table works as well as a file
    listing. Both lookups are reduced to one row per recording first.
    """

    existing = manifests.select("recording_id").distinct().withColumn("has_manifest", F.lit(True))
    last = latest_status(status.select("recording_id", "updated_at", "status")).select(
        "recording_id", "status"
    )
    manifest_root = resolve(dataset_root, manifest_dir)
    chunks_root = resolve(dataset_root, chunks_dir)
    joined = recordings.join(existing, "recording_id", "left").join(last, "recording_id", "left")
    if not include_existing:
        joined = joined.filter(F.col("has_manifest").isNull() | needs_resume())
    plan = joined.select(
        "recording_id",
        "audio_path",
        F.concat(F.lit(f"{manifest_root}/"), "recording_id", F.lit(".csv")).alias("manifest_path"),
        F.concat(F.lit(f"{chunks_root}/"), "recording_id").alias("chunk_output_dir"),
        F.lit(float(chunk_duration)).alias("chunk_duration"),
        F.lit(float(overlap)).alias("overlap"),
        "status",
        F.coalesce("has_manifest", F.lit(False)).alias("has_manifest"),
    )
    return plan.orderBy("audio_path").limit(limit) if limit else plan


def runnable_plans(plan: DataFrame, include_existing: bool = False) -> DataFrame:
    """Drop plans that turn out finished by the time they are applied."""

    if include_existing:
        return plan
    finished = F.coalesce(F.col("status") == COMPLETED, F.lit(False)) & F.col("has_manifest")
    return plan.filter(~finished)
