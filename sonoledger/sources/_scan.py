"""Helpers shared by the readers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import posix_path

# Error conditions Spark reports when a path holds nothing to read.
_NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}

# Spark lists each folder in a task of its own, up to thousands, unless this says fewer.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4


@contextmanager
def set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds while a frame is built, as it was before afterwards."""

    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def listing_tasks(spark: SparkSession) -> str:
    """Tasks that list folders: every core busy, many folders in each."""

    return str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def nothing_there(exc: AnalysisException) -> bool:
    return exc.getCondition() in _NOTHING_THERE


def line_order() -> Column:
    """Place of a row in its file, exact even when a file is split across tasks.

    The running row number is only ever compared inside one split of one file,
    which one task reads from top to bottom.
    """

    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def file_order() -> Column:
    """Like :func:`line_order` without the row number, for streams."""

    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.lit(0).cast("bigint").alias("row"),
    )


def scan_path() -> Column:
    return posix_path(F.col("_metadata.file_path"), encoded=True)


def pick(df: DataFrame, name: str) -> Column:
    """Column by header name, NULL text where the file does not have it."""

    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string").alias(name)
