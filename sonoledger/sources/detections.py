"""The canonical detections table: Parquet in and out, CSV out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.schemas import DETECTIONS
from sonoledger.sources._scan import nothing_there

# File names looked for in a folder of exports, in this order.
EXPORT_GLOBS = ["*_detections.parquet", "*.parquet"]


def read_detection_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.parquet(*paths)


def read_detection_folder(
    spark: SparkSession, folder: str, merge_schema: bool = False
) -> DataFrame | None:
    """All exports in a folder as one table; ``None`` when it holds none.

    Files ending in ``_detections.parquet`` are taken; any Parquet file only
    where there are none of those. A folder that does not exist is an error.
    """

    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    for glob in EXPORT_GLOBS:
        try:
            return reader.parquet(f"{folder.rstrip('/')}/{glob}")
        except AnalysisException as exc:
            if not nothing_there(exc):
                raise
    try:
        spark.read.format("binaryFile").load(folder).limit(0).count()
    except AnalysisException as exc:
        if nothing_there(exc):
            raise ValueError(f"{folder} does not exist or is not a directory") from exc
        raise
    return None


def write_detections(
    detections: DataFrame, path: str, clustered: bool = False, mode: str = "overwrite"
) -> str:
    """Write the 18 columns as Parquet.

    ``clustered`` range-partitions by recording and time first. The range key
    ends in the window and offset, so one huge recording is cut over many files
    and each file covers a narrow key range that later filters can skip.
    """

    table = detections.select(*DETECTIONS.names)
    if clustered:
        keys = ["recording_id", "chunk_start_ms", "chunk_id", "timestamp_ms"]
        table = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table.write.mode(mode).parquet(path)
    return path


def write_detections_csv(detections: DataFrame, path: str) -> str:
    """Write the 18 columns as quoted CSV with a header; NULL is an empty field."""

    (
        detections.select(*DETECTIONS.names)
        .write.mode("overwrite")
        .csv(path, header=True, nullValue="", emptyValue="", escape='"')
    )
    return path


def exclude_placeholders(detections: DataFrame) -> DataFrame:
    """Drop the rows that only say a window was scored without a detection."""

    placeholder = (
        (F.col("label") == "none") & F.col("timestamp_ms").isNull() & F.col("confidence").isNull()
    )
    return detections.filter(~F.coalesce(placeholder, F.lit(False)))
