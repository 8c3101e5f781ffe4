"""Window manifests and saved plan files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import stem
from sonoledger.functions.scalars import blank_to_null, first_text, tolerant_long
from sonoledger.schemas import MANIFEST
from sonoledger.sources._scan import line_order, pick

# Marks written in place of a checksum that was not computed.
HASH_PENDING = "TODO_HASH"
HASH_DRY_RUN = "DRY_RUN"


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest CSV rows by header name, with ``row_order`` for last-row-wins."""

    # Files whose header differs from the first are refused, not misread.
    rows = spark.read.csv(path, header=True, escape='"', enforceSchema=False)
    return rows.select(
        *[
            (
                tolerant_long(pick(rows, f.name))
                if f.dataType.typeName() == "long"
                else blank_to_null(pick(rows, f.name))
            ).alias(f.name)
            for f in MANIFEST
        ],
        line_order().alias("row_order"),
    )


def manifest_index(manifest: DataFrame) -> DataFrame:
    """One row per ``chunk_id``: the last one listed. Rows without an id are dropped."""

    fields = [f.name for f in MANIFEST if f.name != "chunk_id"]
    last = F.max_by(F.struct(*fields), F.col("row_order")).alias("last")
    return (
        manifest.filter(blank_to_null("chunk_id").isNotNull())
        .groupBy("chunk_id")
        .agg(last)
        .select("chunk_id", "last.*")
    )


def write_manifest(windows: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Manifest rows for planned windows; without a checksum the mark says so.

    Parquet by default; ``fmt='csv'`` writes the interchange form.
    """

    columns = [
        F.coalesce(F.col(f.name), F.lit(HASH_PENDING)).alias(f.name)
        if f.name == "sha256" and f.name in windows.columns
        else F.lit(HASH_PENDING).alias(f.name)
        if f.name == "sha256"
        else F.col(f.name)
        if f.name in windows.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in MANIFEST
    ]
    writer = windows.select(*columns).write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, nullValue="", emptyValue="", escape='"')
    else:
        writer.parquet(path)
    return path


def read_plan_manifests(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Manifest paths named by a saved plan, CSV or JSON by ending, in file order.

    ``lines`` reads JSON with one object per line instead of one array.
    """

    if path.lower().endswith(".json"):
        rows = spark.read.json(path, multiLine=not lines)
    else:
        rows = spark.read.csv(path, header=True, escape='"')
    return (
        rows.select(
            first_text(pick(rows, "manifest_path"), pick(rows, "manifest")).alias("manifest_path"),
            line_order().alias("plan_order"),
        )
        .filter(F.col("manifest_path").isNotNull())
        .withColumn("recording_id", stem("manifest_path"))
    )
