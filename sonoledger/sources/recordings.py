"""Audio files: discovery by listing, header facts by short range reads."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoledger.functions.paths import posix_path, stem
from sonoledger.schemas import RECORDINGS

AUDIO_FOLDER = "audio"
# Format tags of a WAV file. The extensible one names the real one further on.
PCM, EXTENSIBLE = 0x0001, 0xFFFE


def discover_recordings(
    spark: SparkSession, dataset_root: str, glob: str = "*.wav"
) -> DataFrame:
    """Audio files below ``<root>/audio``; only the listing is used, no content.

    A recording goes by its file name. Where several files have one name, each goes by
    its path below the audio folder, ``/`` written as ``__``.
    """

    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(f"{dataset_root.rstrip('/')}/{AUDIO_FOLDER}")
    )
    path = posix_path("path")
    listed = files.select(stem(path).alias("name"), path.alias("audio_path"), F.col("length"))
    # Names are counted first: nearly all are one row, so nothing gathers.
    repeated = listed.groupBy("name").count().filter("count > 1").select("name", F.lit(True).alias("repeated"))
    below = F.substring_index("audio_path", f"/{AUDIO_FOLDER}/", -1)
    full = F.replace(F.regexp_replace(below, r"(?<=.)\.[^./]+$", ""), F.lit("/"), F.lit("__"))
    return listed.join(repeated, "name", "left").select(
        F.when(F.col("repeated"), full).otherwise(F.col("name")).alias("recording_id"), "audio_path", "length"
    )


def read_wav_headers(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """Channels, width, rate and frame count of each WAV file.

    Each task opens its files and reads header bytes only, so recordings of any
    length fit. A file that cannot be read yields a row with ``error`` set.
    """

    listed = files.select("recording_id", "audio_path", "length")
    if partitions:
        listed = listed.repartition(partitions)
    return listed.mapInPandas(_headers, RECORDINGS)


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for rec in batch.itertuples(index=False):
            try:
                facts, error = wav_facts(rec.audio_path), None
            except (OSError, ValueError, struct.error) as exc:
                facts, error = {}, f"{type(exc).__name__}: {exc}"
            rows.append(
                {
                    "recording_id": rec.recording_id,
                    "audio_path": rec.audio_path,
                    "length": rec.length,
                    **facts,
                    "error": error,
                }
            )
        yield pd.DataFrame(rows, columns=RECORDINGS.names).astype(object)


def open_random_access(path: str):
    """A seekable file on any filesystem Arrow knows."""

    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def wav_facts(path: str) -> dict[str, int | float]:
    """Walk the RIFF blocks up to the sample data of a PCM file."""

    with open_random_access(path) as source:
        head = source.read(12)
        if len(head) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
            raise ValueError("not a RIFF/WAVE file")
        shape = None
        while len(tag := source.read(8)) == 8:
            name, size = struct.unpack("<4sI", tag)
            if name == b"fmt ":
                block = source.read(size + size % 2)
                tag, channels, rate, _, _, bits = struct.unpack("<HHIIHH", block[:16])
                if tag == EXTENSIBLE and len(block) >= 26:
                    tag = struct.unpack("<H", block[24:26])[0]
                if tag != PCM:
                    raise ValueError(f"unknown format: {tag}")
                shape = (channels, rate, (bits + 7) // 8)
            elif name == b"data":
                if shape is None:
                    raise ValueError("sample data before format block")
                channels, rate, width = shape
                if channels == 0 or width == 0:
                    raise ValueError("format block without channels or width")
                frames = size // (channels * width)
                return {
                    "channels": channels,
                    "sample_rate": rate,
                    "sample_width_bytes": width,
                    "data_offset": source.tell(),
                    "n_frames": frames,
                    "duration_s": frames / rate if rate else 0.0,
                }
            else:
                source.seek(source.tell() + size + size % 2)
    raise ValueError("no sample data block")
