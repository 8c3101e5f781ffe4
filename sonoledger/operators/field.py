"""What field analysts add to detections: place and time, merged overlaps, sites, quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.functions.paths import basename, directory

# Species codes of the target list.
TARGET_CODES = ["ROPT", "RUGR", "STGR", "SPGR", "WIPT"]
# Folders between a station and its files.
CONTAINER_FOLDERS = ["A", "B", "Data"]


def study_area(path: Column | str, root: str) -> Column:
    """The first folder below ``root``; NULL for a path outside it."""

    path = F.col(path) if isinstance(path, str) else path
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.split_part(F.substr(path, F.lit(len(base) + 1)), F.lit("/"), F.lit(1)))


def station(path: Column | str, containers: Sequence[str] = tuple(CONTAINER_FOLDERS)) -> Column:
    """The nearest folder above a file that is not a mere container."""

    folders = F.split(directory(path), "/")
    named = F.filter(folders, lambda f: ~f.isin(*containers) & (f != "")) if containers else folders
    return F.try_element_at(named, F.lit(-1))


def recorded_at(path: Column | str) -> Column:
    """Start of a recording from ``yyyyMMdd_HHmmss`` in its file name, NULL if absent or no date."""

    found = F.regexp_extract(basename(path), r"(?:^|\D)(\d{8}_\d{6})(?:\D|$)", 1)
    return F.try_to_timestamp(F.when(found != "", found), F.lit("yyyyMMdd_HHmmss"))


def with_recording_facts(rows: DataFrame, root: str, path_col: str = "source_path") -> DataFrame:
    return rows.withColumns(
        {"study_area": study_area(path_col, root), "location": station(path_col), "recording_date_time": recorded_at(path_col)}
    )


# Length of the time blocks in which overlaps are merged first.
BLOCK_MS = 3_600_000


def merge_overlaps(detections: DataFrame, gap_ms: int = 0, block_ms: int = BLOCK_MS) -> DataFrame:
    """One row per run of overlapping detections of a label in a recording.

    Rows that begin at most ``gap_ms`` after everything before has ended belong together.
    The row with the best confidence stands for the run, with the run's start and end and
    ``merged``, the rows in it. Rows without a start are runs of their own.

    Rows are merged within blocks of ``block_ms`` by their start, so a label of a recording
    is spread over as many tasks as it has blocks. A block leaves a few runs (start, reach,
    best row); block reaches, one row each, tell how far everything before a block has come,
    and runs are joined where that is beyond their start. Runs are numbered by the runs
    before them in their block and by the breaks in the blocks before it.
    """

    end = F.greatest("absolute_time_ms", F.coalesce("absolute_end_ms", "absolute_time_ms"))
    kept = [c for c in detections.columns if c not in ("recording_id", "label", "absolute_time_ms", "absolute_end_ms")]
    rank = F.struct(F.coalesce("confidence", F.lit(float("-inf"))), -F.coalesce("absolute_time_ms", F.lit(0)), F.col("chunk_id"))
    key = ["recording_id", "label"]
    shaped = detections.select(
        *key, F.col("absolute_time_ms").alias("_start"), end.alias("_end"), rank.alias("_rank"), F.struct(*kept).alias("_row")
    )
    # Rows that begin together are in one run: one row for each start, however many there are.
    timed = (
        shaped.filter("_start IS NOT NULL").groupBy(*key, "_start")
        .agg(F.max("_end").alias("_end"), F.max_by("_row", "_rank").alias("_row"), F.max("_rank").alias("_rank"),
             F.count("*").alias("_rows"))
        .withColumn("_block", F.floor(F.col("_start") / block_ms))
    )
    in_block = Window.partitionBy(*key, "_block").orderBy("_start")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.coalesce(F.col("_start") > F.max("_end").over(before) + gap_ms, F.lit(True))
    numbered = timed.withColumn("_fresh", fresh.cast("int")).withColumn("_run", F.sum("_fresh").over(so_far))
    # Runs of a block, and how far the block reaches.
    runs = numbered.groupBy(*key, "_block", "_run").agg(
        F.max_by("_row", "_rank").alias("_row"), F.max("_rank").alias("_rank"), F.min("_start").alias("_start"),
        F.max("_end").alias("_end"), F.sum("_rows").alias("_rows"),
    )
    blocks = timed.groupBy(*key, "_block").agg(F.max("_end").alias("_reach"))
    over_blocks = Window.partitionBy(*key).orderBy("_block")
    reached = blocks.withColumn("_before", F.max("_reach").over(over_blocks.rowsBetween(Window.unboundedPreceding, -1))).drop("_reach")
    # A run is joined with what lies before if that reaches it: the first runs of a block, or all of them.
    opened = _with_block(runs, reached).withColumn("_opens", F.coalesce(F.col("_start") > F.col("_before") + gap_ms, F.lit(True)).cast("int"))
    breaks = opened.groupBy(*key, "_block").agg(F.sum("_opens").alias("_breaks"))
    earlier = breaks.withColumn(
        "_earlier", F.coalesce(F.sum("_breaks").over(over_blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_breaks")
    inside = Window.partitionBy(*key, "_block").orderBy("_run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = _with_block(opened, earlier).withColumn(
        "_run", F.col("_earlier") + F.sum("_opens").over(inside)
    )
    merged = whole.groupBy(*key, "_run").agg(
        F.max_by("_row", "_rank").alias("_best"), F.min("_start").alias("absolute_time_ms"),
        F.max("_end").alias("absolute_end_ms"), F.sum("_rows").alias("merged"),
    )
    alone = shaped.filter("_start IS NULL").select(
        *key, F.col("_row").alias("_best"), F.col("_start").alias("absolute_time_ms"), F.col("_end").alias("absolute_end_ms"),
        F.lit(1).cast("bigint").alias("merged"),
    )
    return merged.drop("_run").unionByName(alone).select(
        *key, "absolute_time_ms", "absolute_end_ms", *[F.col(f"_best.{c}").alias(c) for c in kept], "merged"
    )


def _with_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The one further column of ``blocks`` for rows of a (recording, label, block)."""

    other = blocks.toDF("_of_recording", "_of_label", "_of_block", blocks.columns[-1])
    same = (
        F.col("recording_id").eqNullSafe(F.col("_of_recording")) & F.col("label").eqNullSafe(F.col("_of_label"))
        & (F.col("_block") == F.col("_of_block"))
    )
    return rows.join(other, same).drop("_of_recording", "_of_label", "_of_block")


def merge_study_areas(areas: Mapping[str, DataFrame], codes: Sequence[str] | None = TARGET_CODES) -> DataFrame:
    """Detections of several study areas as one table, only ``codes`` if given."""

    named = [rows.withColumn("study_area", F.lit(area)) for area, rows in areas.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return merged if codes is None else merged.filter(F.col("label_code").isin(*codes))


def runtime_and_confidence(events: DataFrame, detections: DataFrame) -> DataFrame:
    """Per window: attempts, longest successful run time, device, detections, mean confidence."""

    good = F.lower("status") == "success"
    ran = events.groupBy("chunk_id").agg(
        F.count_if(good).alias("successes"), F.max(F.when(good, F.col("runtime_s"))).alias("runtime_s"),
        F.max("gpu_index").alias("gpu_index"),
    )
    heard = detections.groupBy("chunk_id").agg(
        F.count("confidence").alias("detections"), F.avg("confidence").alias("avg_confidence")
    )
    return ran.join(heard, "chunk_id", "left").withColumn("detections", F.coalesce("detections", F.lit(0)))


def attach_sites(detections: DataFrame, sites: DataFrame, key: str = "location") -> DataFrame:
    """Site columns by station. ``sites`` has one row per station; the join's way is left to its size."""

    return detections.join(sites, key, "left")


def quality_counts(results: DataFrame, detections: DataFrame, low: float = 0.5) -> DataFrame:
    """Per recording: windows processed and failed, detections and those below ``low``."""

    failed = F.col("status") != "success"
    ran = results.groupBy("recording_id").agg(
        F.count("*").alias("chunks"), F.count_if(failed).alias("failures")
    )
    heard = detections.groupBy("recording_id").agg(
        F.count("confidence").alias("detections"), F.count_if(F.col("confidence") < low).alias("low_confidence")
    )
    zero = F.lit(0).cast("bigint")
    same = ran["recording_id"].eqNullSafe(heard["recording_id"])
    return ran.join(heard, same, "full").select(
        F.coalesce(ran["recording_id"], heard["recording_id"]).alias("recording_id"),
        *[F.coalesce(c, zero).alias(c) for c in ("chunks", "failures", "detections", "low_confidence")],
    )


def changed_windows(manifest: DataFrame, blobs: DataFrame) -> DataFrame:
    """Manifest rows whose audio is ``missing`` or has another checksum (``changed``).

    Only checksums of ``content`` leave the scan of the audio.
    """

    held = blobs.filter(F.col("content").isNotNull()).select(
        "recording_id", "chunk_id", F.sha2("content", 256).alias("found_sha256")
    )
    joined = manifest.join(held, ["recording_id", "chunk_id"], "left")
    problem = F.when(F.col("found_sha256").isNull(), "missing").when(
        F.col("sha256").isNotNull() & (F.col("sha256") != F.col("found_sha256")), "changed"
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull())
