"""Detector payloads: one JSON object per file, every key optional."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import parent_name, stem
from sonoledger.functions.scalars import blank_to_null, tolerant_double, tolerant_long
from sonoledger.sources._scan import LISTING_TASKS, listing_tasks, scan_path, set_for

# Top-level keys of a payload. RAW_OUTPUT_KEY names the folder holding the
# detector's raw label file.
PAYLOAD_TEXT_KEYS = ["source_path", "status", "runner", "dataset_root", "model_version"]
RAW_OUTPUT_KEY = "hawkears_output"

# A repeated key counts with its last value, as in Python's JSON reader.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"

# Text keys cannot fail to read; the nested ones stay open, as they may hold anything.
_TOP = "STRUCT<" + ", ".join(
    [f"{k}: STRING" for k in ["recording_id", *PAYLOAD_TEXT_KEYS]]
    + [f"{k}: VARIANT" for k in ["chunk_id", "chunk", "detections"]]
) + ">"
_CHUNK = "STRUCT<start_ms: STRING, end_ms: STRING, sha256: STRING>"
_DETECTION = (
    "STRUCT<timestamp_ms: STRING, end_ms: STRING, label: STRING, label_code: STRING,"
    " label_name: STRING, confidence: STRING>"
)


def read_payloads(spark: SparkSession, root: str, raw_output_key: str = RAW_OUTPUT_KEY) -> DataFrame:
    """Every ``*.json`` below ``root``, parsed; unreadable files are left out."""

    return parse_payloads(scan_payload_text(spark, root), raw_output_key)


def _last_value_of_repeated_keys(spark: SparkSession) -> AbstractContextManager[None]:
    """The setting is read where a JSON expression is built, not where it runs."""

    return set_for(spark, REPEATED_KEYS, "true")


def scan_payload_text(spark: SparkSession, root: str) -> DataFrame:
    """``(file_path, value)`` per JSON file below ``root``."""

    with set_for(spark, LISTING_TASKS, listing_tasks(spark)):
        lines = spark.read.text(
            root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json"
        )
    return lines.select(scan_path().alias("file_path"), F.col("value"))


def _is_object(text: Column) -> Column:
    """Whether text, if it is JSON at all, is an object."""

    return text.rlike(r"^\s*\{")


def parse_payloads(files: DataFrame, raw_output_key: str = RAW_OUTPUT_KEY) -> DataFrame:
    """Turn ``(file_path, value)`` rows into typed payload rows.

    Text that is not a JSON object is dropped (see :func:`count_unreadable`).
    ``detections`` stays an array of small structs; the caller explodes it.
    """

    with _last_value_of_repeated_keys(files.sparkSession):
        return _parsed(files, raw_output_key)


def _parsed(files: DataFrame, raw_output_key: str) -> DataFrame:

    doc, top, chunk = F.col("doc"), F.col("top"), F.col("chunk_block")
    # One typed read per level; the fields below are then plain struct accesses.
    # Exploding a list of one or none drops bad text and parses once; a filter on
    # the parsed value would be pushed down and parse a second time.
    parsed = (
        files.filter(_is_object(F.col("value")))
        .withColumn("doc", F.explode(F.array_compact(F.array(F.try_parse_json("value")))))
        .withColumn("top", F.try_variant_get(doc, "$", _TOP))
        .withColumn("chunk_block", F.try_variant_get(top["chunk"], "$", _CHUNK))
        .withColumn("detection_rows", _detection_rows(top["detections"]))
    )
    raw_dir = F.try_variant_get(doc, f"$.{raw_output_key}", "string")
    return parsed.select(
        "file_path",
        # Only an absent key falls back to the file stem; an explicit null stays null.
        F.when(top["chunk_id"].isNull(), stem("file_path"))
        .otherwise(top["chunk_id"].try_cast("string"))
        .alias("chunk_id"),
        blank_to_null(top["recording_id"]).alias("recording_id"),
        parent_name("file_path").alias("parent_dir"),
        *[blank_to_null(top[k]).alias(k) for k in PAYLOAD_TEXT_KEYS],
        tolerant_long(chunk["start_ms"]).alias("chunk_start_ms"),
        tolerant_long(chunk["end_ms"]).alias("chunk_end_ms"),
        blank_to_null(chunk["sha256"]).alias("chunk_sha256"),
        blank_to_null(raw_dir).alias("label_dir"),
        F.transform("detection_rows", _detection).alias("detections"),
    )


def _detection_rows(items: Column) -> Column:
    """The list in one cast; item by item only where one of them is no object."""

    return F.coalesce(
        F.try_variant_get(items, "$", f"ARRAY<{_DETECTION}>"),
        F.transform(
            F.try_variant_get(items, "$", "array<variant>"),
            lambda item: F.try_variant_get(item, "$", _DETECTION),
        ),
    )


def _detection(det: Column) -> Column:
    return F.struct(
        tolerant_long(det["timestamp_ms"]).alias("timestamp_ms"),
        tolerant_long(det["end_ms"]).alias("end_ms"),
        F.coalesce(det["label"], F.lit("unknown")).alias("label"),
        det["label_code"].alias("label_code"),
        det["label_name"].alias("label_name"),
        tolerant_double(det["confidence"]).alias("confidence"),
    )


def count_unreadable(files: DataFrame) -> DataFrame:
    """One row: payload files seen, and how many are not a JSON object."""

    with _last_value_of_repeated_keys(files.sparkSession):
        readable = F.try_parse_json("value").isNotNull() & _is_object(F.col("value"))
        return files.agg(
            F.count("*").alias("files"), F.count_if(~readable).alias("unreadable")
        )
