"""Materialising windows as small WAV blobs."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.schemas import CHUNK_BLOBS
from sonoledger.sources.recordings import open_random_access

_INPUT = [
    "recording_id", "chunk_id", "source_path", "audio_path", "start_ms", "end_ms", "overlap_ms",
    "start_frame", "end_frame", "data_offset", "channels", "sample_rate", "sample_width_bytes",
]


def cut_windows(windows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each window as a WAV of its own, with the SHA-256 of those bytes.

    ``windows`` are planned windows of recordings with header facts. A task reads
    just the byte range of each window, so neither the length of a recording nor
    the share of windows it holds matters. A window whose bytes cannot be read
    is a row with ``error``.
    """

    rows = windows.select(*_INPUT)
    if partitions:
        rows = rows.repartition(partitions)
    blobs = rows.mapInPandas(_slice, CHUNK_BLOBS)
    return blobs.withColumn("sha256", F.sha2("content", 256))


def _slice(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, group in batch.groupby("audio_path", sort=False):
            source, failure = None, None
            try:
                source = open_random_access(group.audio_path.iloc[0])
            except (OSError, ValueError) as exc:
                failure = f"{type(exc).__name__}: {exc}"
            for row in group.itertuples(index=False):
                content, error = None, failure
                if source is not None:
                    try:
                        content = _window_wav(source, row)
                    except (OSError, ValueError, struct.error) as exc:
                        error = f"{type(exc).__name__}: {exc}"
                # One row per output batch: the blob sizes add up otherwise.
                yield pd.DataFrame(
                    [[row.recording_id, row.chunk_id, row.source_path, row.audio_path,
                      row.start_ms, row.end_ms, row.overlap_ms, content, error]],
                    columns=CHUNK_BLOBS.names,
                )
            if source is not None:
                source.close()


def _window_wav(source, row) -> bytes:
    frame = int(row.channels) * int(row.sample_width_bytes)
    source.seek(int(row.data_offset) + int(row.start_frame) * frame)
    wanted = (int(row.end_frame) - int(row.start_frame)) * frame
    samples = source.read(wanted)
    if len(samples) != wanted:
        raise ValueError(f"window ends early: {len(samples)} of {wanted} bytes")
    target = io.BytesIO()
    with wave.open(target, "wb") as out:
        out.setnchannels(int(row.channels))
        out.setsampwidth(int(row.sample_width_bytes))
        out.setframerate(int(row.sample_rate))
        out.writeframes(samples)
    return target.getvalue()


def manifest_from_blobs(blobs: DataFrame) -> DataFrame:
    """Manifest rows, checksum included, of written windows."""

    return blobs.filter(F.col("error").isNull()).select(
        "recording_id", "chunk_id", "source_path", "start_ms", "end_ms", "overlap_ms", "sha256",
        F.lit(None).cast("string").alias("notes"),
    )


def export_wav_files(blobs: DataFrame) -> DataFrame:
    """Write every blob to its ``source_path``; returns the paths written.

    For detectors that want files. Writing the same bytes to the same path again
    is harmless, so a lost and repeated task does no damage.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path, content in zip(batch.source_path, batch.content):
                system, inner = (
                    fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
                )
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as out:
                    out.write(content)
            yield batch[["chunk_id", "source_path"]]

    wanted = blobs.filter(F.col("content").isNotNull()).select("chunk_id", "source_path", "content")
    return wanted.mapInPandas(write, "chunk_id STRING, source_path STRING")
