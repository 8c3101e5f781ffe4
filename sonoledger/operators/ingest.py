"""Payloads, manifest and raw label files to the canonical detections table."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import basename, tidy_path
from sonoledger.functions.scalars import absolute_time, first_text
from sonoledger.operators.dataset_roots import attach_dataset_root, find_dataset_roots
from sonoledger.schemas import DETECTIONS
from sonoledger.session import materialise
from sonoledger.sources._scan import nothing_there
from sonoledger.sources.detections import write_detections, write_detections_csv
from sonoledger.sources.labels import (
    LABEL_FILE_NAME,
    fetch_labels,
    list_label_dirs,
    normalise_labels,
    read_raw_labels,
)
from sonoledger.sources.manifests import manifest_index, read_manifest
from sonoledger.sources.payloads import RAW_OUTPUT_KEY, read_payloads

# Texts written where the payload has none.
PLACEHOLDER_LABEL = "none"
STATUS_WITH_DETECTIONS = "ok"
STATUS_WITHOUT_DETECTIONS = "unknown"
STATUS_NO_ROWS = "no_detections"
STATUS_NO_FILE = "no_output"

# No file name, so it can stand for all of them.
ANY_NAME = "/"
# Parts a folder's blank file name is dealt over.
BLANK_SALTS = 8

_LABEL_FIELDS = ["timestamp_ms", "end_ms", "label", "label_code", "label_name", "confidence"]


def enrich_payloads(
    payloads: DataFrame,
    manifest: DataFrame | None = None,
    dataset_roots: DataFrame | None = None,
) -> DataFrame:
    """Fill what a payload leaves open: from the manifest, then from its own path.

    The manifest is reduced to one row per window before the outer join, so rows
    never multiply; one without ``row_order`` is taken to be reduced already. No
    broadcast is forced: that is left to the reduced manifest's real size.
    """

    if manifest is not None:
        index = manifest_index(manifest) if "row_order" in manifest.columns else manifest
        known = index.select(
            "chunk_id",
            F.col("recording_id").alias("m_recording_id"),
            F.col("source_path").alias("m_source_path"),
            F.col("start_ms").alias("m_start_ms"),
            F.col("end_ms").alias("m_end_ms"),
            F.col("sha256").alias("m_sha256"),
        )
        # One row per window on the right and about one on the left: nothing to split.
        joined = payloads.join(known, "chunk_id", "left")
    else:
        joined = payloads.withColumns(
            {
                "m_recording_id": F.lit(None).cast("string"),
                "m_source_path": F.lit(None).cast("string"),
                "m_start_ms": F.lit(None).cast("bigint"),
                "m_end_ms": F.lit(None).cast("bigint"),
                "m_sha256": F.lit(None).cast("string"),
            }
        )
    resolved = joined.select(
        "file_path",
        first_text("recording_id", "m_recording_id", "parent_dir").alias("recording_id"),
        "chunk_id",
        F.coalesce("chunk_start_ms", "m_start_ms").alias("chunk_start_ms"),
        F.coalesce("chunk_end_ms", "m_end_ms").alias("chunk_end_ms"),
        "status",
        "runner",
        "model_version",
        first_text("chunk_sha256", "m_sha256").alias("chunk_sha256"),
        first_text("source_path", "m_source_path").alias("chunk_source"),
        first_text("dataset_root").alias("dataset_root"),
        "m_source_path",
        "label_dir",
        "detections",
    )
    if dataset_roots is not None:
        found = attach_dataset_root(resolved, dataset_roots, "chunk_source", "found_root")
        resolved = found.withColumn("dataset_root", F.coalesce("dataset_root", "found_root")).drop(
            "found_root"
        )
    return resolved


def _has_detections() -> Column:
    return F.coalesce(F.size("detections"), F.lit(0)) > 0


def _canonical(rows: DataFrame, default_status: Column) -> DataFrame:
    """18 columns from enriched rows that carry one ``det`` struct (or NULL)."""

    det = {name: F.col(f"det.{name}") for name in _LABEL_FIELDS}
    return rows.select(
        F.col("recording_id"),
        F.col("chunk_id"),
        F.col("chunk_start_ms"),
        F.col("chunk_end_ms"),
        det["timestamp_ms"].alias("timestamp_ms"),
        absolute_time("chunk_start_ms", det["timestamp_ms"]).alias("absolute_time_ms"),
        det["end_ms"].alias("end_ms"),
        absolute_time("chunk_start_ms", det["end_ms"]).alias("absolute_end_ms"),
        F.when(F.col("det").isNull(), F.lit(PLACEHOLDER_LABEL))
        .otherwise(det["label"])
        .alias("label"),
        det["label_code"].alias("label_code"),
        det["label_name"].alias("label_name"),
        det["confidence"].alias("confidence"),
        first_text("status", default_status).alias("status"),
        F.col("runner"),
        F.col("model_version"),
        F.col("chunk_sha256"),
        F.coalesce("chunk_source", "file_path").alias("source_path"),
        F.col("dataset_root"),
    ).select(*DETECTIONS.names)


def explode_detections(enriched: DataFrame) -> DataFrame:
    """One row per detection; a payload without any gives one placeholder row."""

    rows = enriched.withColumn("det", F.explode_outer("detections"))
    default = F.when(F.col("det").isNull(), F.lit(STATUS_WITHOUT_DETECTIONS)).otherwise(
        F.lit(STATUS_WITH_DETECTIONS)
    )
    return _canonical(rows, default)


def window_names(pending: DataFrame) -> DataFrame:
    """Each payload once per name its label rows may carry, in ``file_name``.

    A label row belongs to a payload if its file name is one of the names the
    window goes by, or if it has no file name. Spreading a payload over its few
    distinct names plus the empty one makes matching a plain equi-join on
    (folder, name): no residual test, and no label row can match twice. A payload
    that goes by no name at all gets ``ANY_NAME`` instead, which stands for every row.
    """

    names = F.array_distinct(
        F.array_compact(
            F.array(
                basename("chunk_id"),
                basename("chunk_source"),
                basename("m_source_path"),
                F.lit(""),
            )
        )
    )
    nameless = F.size(names) == 1
    return pending.withColumn("file_name", F.explode(F.when(nameless, F.array(F.lit(ANY_NAME))).otherwise(names)))


def _needs_labels() -> Column:
    return ~_has_detections() & F.col("label_dir").isNotNull()


def _label_place(label_base: str | None, home: str = "") -> Column:
    """Where a payload's label folder lies, from what the payload says.

    Relative folders are taken from ``label_base`` (the working directory, if not given),
    those without a scheme from the filesystem ``home``.
    """

    base = (label_base or os.getcwd()).rstrip("/")
    named = F.regexp_replace("label_dir", "^file:/+", "/")
    place = (
        F.when(named.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), named)
        .when(named.startswith("/"), F.concat(F.lit(home), named))
        .otherwise(F.concat(F.lit(f"{base}/"), F.regexp_replace(named, r"^(\./)+", "")))
    )
    # One spelling each, so that a folder is opened once: no slashes at the end or doubled, but for the scheme's.
    return F.rtrim(F.regexp_replace(place, "(?<![:/])/{2,}", "/"), F.lit("/"))


def detections_with_labels(
    enriched: DataFrame, labels: DataFrame, label_dirs: DataFrame, label_base: str | None = None, home: str = ""
) -> DataFrame:
    """Like :func:`explode_detections`, reading label rows where a payload is empty.

    Windows by name are joined with label rows once. Which payloads got none is told from
    keys alone: those whose (folder, name) occurs among the label rows are known without
    looking at the rows, the others keep one placeholder, ``no_detections`` if their folder
    is in ``label_dirs``, else ``no_output``. Only the blank name of a folder can gather
    many windows; its windows are dealt over ``BLANK_SALTS``, its label rows copied as often.
    """

    direct = explode_detections(enriched.filter(~_needs_labels()))
    place = F.regexp_replace(_label_place(label_base, home), "/+", "/")
    # Folders and names are worked out once; every branch below reads them. A payload goes by a
    # number, which is shorter than its path wherever rows are shuffled.
    pending = enriched.filter(_needs_labels()).withColumn("label_dir", place).withColumn("payload", F.monotonically_increasing_id())
    named = materialise(window_names(pending).drop("detections"), "named-windows", "zstd")
    blank = F.col("file_name").isin("", ANY_NAME)
    keys = ["label_dir", "file_name"]
    # Rows once more under the name that stands for all, in folders where a payload has it. These
    # are written first: a join with few of them, or none, then needs no shuffle of all label rows.
    nameless = materialise(named.filter(F.col("file_name") == ANY_NAME).select("label_dir").distinct(), "nameless")
    rows = labels.select(*keys, *_LABEL_FIELDS)
    every = rows.unionByName(rows.join(nameless, "label_dir", "left_semi").withColumn("file_name", F.lit(ANY_NAME)))
    salt = F.when(blank, F.pmod(F.xxhash64("payload"), F.lit(BLANK_SALTS))).otherwise(0).cast("int")
    salts = F.sequence(F.lit(0), F.when(blank, BLANK_SALTS - 1).otherwise(0))
    hits = named.withColumn("salt", salt).join(every.withColumn("salt", F.explode(salts)), [*keys, "salt"])
    hits = hits.withColumn("det", F.struct(*_LABEL_FIELDS))
    # Keys only: a payload's names beside the names there are. Each payload has one blank name.
    known = every.select(*keys).distinct()
    served = named.select("payload", *keys).join(known, keys, "left_semi").select("payload").distinct()
    there = label_dirs.select("label_dir").distinct().withColumn("has_file", F.lit(True))
    empty = named.filter(blank).join(served, "payload", "left_anti").join(there, "label_dir", "left")
    without = F.when(F.col("has_file"), F.lit(STATUS_NO_ROWS)).otherwise(F.lit(STATUS_NO_FILE))
    none = empty.withColumn("det", F.lit(None).cast(hits.schema["det"].dataType))
    return direct.unionByName(_canonical(hits, F.lit(STATUS_WITH_DETECTIONS))).unionByName(_canonical(none, without))


def read_detections(
    spark: SparkSession,
    root: str,
    manifest: str | DataFrame | None = None,
    label_root: str | None = None,
    dataset_roots: DataFrame | None = None,
    raw_output_key: str = RAW_OUTPUT_KEY,
    label_file: str = LABEL_FILE_NAME,
    label_base: str | None = None,
    find_roots: bool = True,
) -> DataFrame:
    """Detections from a tree of payload files.

    A payload without detections takes them from the ``label_file`` in the folder that
    its ``raw_output_key`` names, wherever that lies: each folder is opened once, in a
    task. With ``label_root`` the files below that folder are scanned instead, one listing
    in place of many small reads, and payloads that name other folders get nothing.
    The enriched payloads are written once to the shared folder, since both branches read
    them. Without ``dataset_roots`` the folders above the payloads' sources are looked up
    for the marker of a dataset.
    """

    table = read_manifest(spark, manifest) if isinstance(manifest, str) else manifest
    enriched = enrich_payloads(read_payloads(spark, root, raw_output_key), table, dataset_roots)
    enriched = materialise(enriched, "payloads", "zstd")
    if dataset_roots is None and find_roots:
        found = attach_dataset_root(enriched, find_dataset_roots(enriched, "chunk_source"), "chunk_source", "found_root")
        enriched = found.withColumn("dataset_root", F.coalesce("dataset_root", "found_root")).drop("found_root")
    if label_root is None:
        home = _home(root)
        folders = enriched.filter(_needs_labels()).select(_label_place(label_base, home).alias("label_dir"))
        lines = materialise(fetch_labels(folders, label_file), "label-lines", "zstd")
        place = tidy_path("label_dir")
        labels = normalise_labels(lines.filter("is_line"), place)
        return detections_with_labels(
            enriched, labels, lines.filter("has_file AND NOT is_line").select(place.alias("label_dir")), label_base, home
        )
    try:
        labels = read_raw_labels(spark, label_root, label_file)
    except AnalysisException as exc:  # no label file at all: no payload has output
        if not nothing_there(exc):
            raise
        return explode_without_label_files(enriched)
    return detections_with_labels(enriched, labels, list_label_dirs(spark, label_root, label_file), label_base)


def _home(root: str) -> str:
    """Scheme and host of a path; nothing for local ones."""

    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/]*", root)
    return found.group() if found and not root.startswith("file:") else ""


def explode_without_label_files(enriched: DataFrame) -> DataFrame:
    rows = enriched.withColumn(
        "status",
        F.when(
            _needs_labels(),
            first_text("status", F.lit(STATUS_NO_FILE)),
        ).otherwise(F.col("status")),
    )
    return explode_detections(rows)


def ingest(
    spark: SparkSession,
    root: str,
    manifest: str | DataFrame | None = None,
    csv_path: str | None = None,
    parquet_path: str | None = None,
    label_root: str | None = None,
    dataset_roots: DataFrame | None = None,
    clustered: bool = False,
    raw_output_key: str = RAW_OUTPUT_KEY,
    label_file: str = LABEL_FILE_NAME,
    label_base: str | None = None,
) -> DataFrame | None:
    """Build the table and export it; ``None`` and no files if there is nothing.

    Payloads are parsed once: the Parquet export (or a shared scratch table) is
    what the CSV export and the caller read.
    """

    detections = read_detections(
        spark, root, manifest, label_root, dataset_roots, raw_output_key, label_file, label_base
    )
    if parquet_path:
        if detections.isEmpty():
            return None
        write_detections(detections, parquet_path, clustered=clustered)
        detections = spark.read.schema(DETECTIONS).parquet(parquet_path)
    else:
        detections = materialise(detections, "detections")
        if detections.isEmpty():
            return None
    if csv_path:
        write_detections_csv(detections, csv_path)
    return detections
