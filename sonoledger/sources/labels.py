"""Raw label CSV files written by a detector, one folder per scored window."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import basename, directory, posix_path
from sonoledger.functions.scalars import (
    blank_to_null,
    first_text,
    seconds_to_ms,
    tolerant_double,
)
from sonoledger.sources._files import open_stream
from sonoledger.sources._scan import pick, scan_path

# File name of raw label files, and the columns read from them.
LABEL_FILE_NAME = "HawkEars_labels.csv"
LABEL_COLUMNS = ["filename", "start_time", "end_time", "class_name", "class_code", "score"]

# Lines that leave a task together, however large a file is.
LINES = 4096


def read_raw_labels(
    spark: SparkSession, root: str, glob: str = LABEL_FILE_NAME
) -> DataFrame:
    """All label files below ``root`` in one scan, keyed by the folder they lie in."""

    rows = spark.read.csv(
        root, header=True, escape='"', enforceSchema=False, recursiveFileLookup=True,
        pathGlobFilter=glob,
    )
    return normalise_labels(rows, directory(scan_path()))


def normalise_labels(rows: DataFrame, label_dir) -> DataFrame:
    """Canonical label columns from raw text columns."""

    code = blank_to_null(pick(rows, "class_code"))
    name = blank_to_null(pick(rows, "class_name"))
    return rows.select(
        label_dir.alias("label_dir"),
        basename(F.coalesce(pick(rows, "filename"), F.lit(""))).alias("file_name"),
        seconds_to_ms(pick(rows, "start_time")).alias("timestamp_ms"),
        seconds_to_ms(pick(rows, "end_time")).alias("end_ms"),
        first_text(code, name, F.lit("unknown")).alias("label"),
        code.alias("label_code"),
        name.alias("label_name"),
        tolerant_double(pick(rows, "score")).alias("confidence"),
    )


def list_label_dirs(
    spark: SparkSession, root: str, glob: str = LABEL_FILE_NAME
) -> DataFrame:
    """Folders that hold a label file, also one without rows; no content is read."""

    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return files.select(directory(posix_path("path")).alias("label_dir")).distinct()


def fetch_labels(
    folders: DataFrame, label_file: str = LABEL_FILE_NAME, partitions: int | None = None
) -> DataFrame:
    """The label file of each folder of ``folders`` (column ``label_dir``), wherever it lies.

    Each distinct folder is opened once, in a task, on any filesystem Arrow knows. Per folder
    there is a row with ``has_file`` and no line, then a row with ``is_line`` for every line of
    its file; a file is streamed, so its length does not matter. A folder or file that isn't
    there is ``has_file = false``; anything else that keeps a file from being read is an error
    of the job, never a silent loss of rows. Opening costs a round trip each, so folders are
    dealt over ``partitions`` tasks (the shuffle partitions, if not given).
    """

    spark = folders.sparkSession
    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = folders.select("label_dir").filter("label_dir IS NOT NULL").distinct().repartition(tasks)
    text = ", ".join(f"{c} string" for c in LABEL_COLUMNS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for row in _lines(folder, label_file):
                    held.append(row)
                    if len(held) == LINES:
                        yield _batch(held)
                        held = []
        if held:
            yield _batch(held)

    return wanted.mapInArrow(work, f"label_dir string, has_file boolean, is_line boolean, {text}")


def _lines(folder: str, label_file: str) -> Iterator[tuple]:
    blank = (None,) * len(LABEL_COLUMNS)
    try:
        source = open_stream(f"{folder}/{label_file}")
    except (FileNotFoundError, NotADirectoryError):
        yield (folder, False, False, *blank)
        return
    yield (folder, True, False, *blank)
    with io.TextIOWrapper(io.BufferedReader(source), encoding="utf-8", errors="replace", newline="") as text:
        rows = csv.DictReader(text)
        while part := list(islice(rows, LINES)):
            for row in part:
                yield (folder, True, True, *(row.get(c) for c in LABEL_COLUMNS))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["label_dir", "has_file", "is_line", *LABEL_COLUMNS]
    kinds = [pa.string(), pa.bool_(), pa.bool_(), *[pa.string()] * len(LABEL_COLUMNS)]
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
