"""Per-recording job status: an append-only table, the latest write counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.schemas import CHUNK_STATUS
from sonoledger.sources._scan import nothing_there

IN_PROGRESS, FAILED, COMPLETED, MISSING = "in_progress", "failed", "completed", "missing"


def append_status(rows: DataFrame, path: str) -> str:
    """Add status rows; columns that do not apply are NULL."""

    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in rows.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in CHUNK_STATUS
    ]
    rows.select(*columns).write.mode("append").parquet(path)
    return path


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """All status rows; a table not yet written is empty."""

    try:
        return spark.read.schema(CHUNK_STATUS).parquet(path)
    except AnalysisException as exc:
        if nothing_there(exc):
            return spark.createDataFrame([], CHUNK_STATUS)
        raise


def latest_status(
    rows: DataFrame, key: str = "recording_id", order: str = "updated_at"
) -> DataFrame:
    """The newest row per key.

    ``max_by`` combines inside each task before the shuffle, so a key holding
    most rows costs no more than any other. On equal times a finished state
    outranks the ``in_progress`` mark it replaces.
    """

    others = [c for c in rows.columns if c != key]
    rank = F.struct(
        F.col(order),
        F.col("status") != F.lit(IN_PROGRESS),
        F.col("status"),
    )
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*others), rank).alias("latest"))
        .select(key, "latest.*")
    )
