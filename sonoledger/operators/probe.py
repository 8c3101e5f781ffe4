"""Longest window a device can hold, per recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoledger.functions.scalars import (
    memory_estimate_mb,
    memory_limit_mb,
    round_hundredths,
)
from sonoledger.operators.skew import spread_join
from sonoledger.schemas import PROBE_ATTEMPTS

# Defaults of the search and texts of its log.
INITIAL_S = 60.0
TOLERANCE_S = 5.0
FITS_TEXT = "fits memory budget"
OVER_TEXT = "Estimated %.1f MiB exceeds limit %.1f MiB"
DEVICE_NOTE = "GPU %d (%s) limit %.0f MiB"
NO_DEVICE_NOTE = "Assumed 4 GiB limit (no GPUs detected)"

_STATE = (
    f"STRUCT<phase: STRING, cand: DOUBLE, low: DOUBLE, high: DOUBLE, attempts: {PROBE_ATTEMPTS}>"
)


def choose_device(recordings: DataFrame, devices: DataFrame | None) -> DataFrame:
    """Attach the device of each recording's ``gpu_index``, else the first device.

    ``devices`` has ``gpu_index, gpu_name, memory_total_mb``, one row per device.
    The first device is a single value and enters as a scalar subquery.
    """

    wanted = (
        F.col("gpu_index") if "gpu_index" in recordings.columns else F.lit(None).cast("bigint")
    )
    rows = recordings.withColumn("wanted", wanted.cast("bigint")).drop("gpu_index")
    kept = [c for c in rows.columns if c != "wanted"]
    if devices is None:
        return rows.select(
            *kept,
            F.lit(None).cast("bigint").alias("gpu_index"),
            F.lit(None).cast("string").alias("gpu_name"),
            F.lit(None).cast("double").alias("memory_total_mb"),
        )
    facts = F.struct("gpu_index", "gpu_name", "memory_total_mb")
    table = devices.select(F.col("gpu_index").cast("bigint").alias("wanted"), facts.alias("own"))
    first = devices.agg(F.min_by(facts, "gpu_index")).scalar()
    known = spread_join(rows, table, "wanted", ["audio_path", "recording_id"])
    return known.withColumn("device", F.coalesce("own", first)).select(*kept, "device.*")


def probe_windows(
    recordings: DataFrame,
    devices: DataFrame | None = None,
    initial_s: float = INITIAL_S,
    max_duration_s: float | None = None,
    tolerance_s: float = TOLERANCE_S,
) -> DataFrame:
    """Search the longest window whose memory estimate stays in the budget.

    Starts at ``initial_s``, halves until something fits, then bisects until the
    gap is within the tolerance. The search is a fold over a short fixed sequence
    inside one projection: no Python, and no shuffle but the device lookup.
    """

    if initial_s <= 0:
        raise ValueError("initial duration must be positive")
    if tolerance_s <= 0:
        raise ValueError("tolerance must be positive")
    tol = F.lit(float(tolerance_s))
    rows = choose_device(recordings, devices).filter(F.col("duration_s") > 0)
    longest = F.col("duration_s")
    if max_duration_s is not None:
        longest = F.least(longest, F.lit(float(max_duration_s)))
    rows = rows.withColumns(
        {
            "longest_s": F.greatest(tol, longest),
            "memory_limit_mb": memory_limit_mb("memory_total_mb"),
            "mb_per_s": memory_estimate_mb(
                F.lit(1.0), "sample_rate", "channels", "sample_width_bytes"
            ),
        }
    )

    def estimate(cand: Column) -> Column:
        return memory_estimate_mb(
            F.least(cand, F.col("longest_s")), "sample_rate", "channels", "sample_width_bytes"
        )

    def state(phase: Column, cand: Column, low: Column, high: Column, log: Column) -> Column:
        return F.struct(
            phase.alias("phase"), cand.alias("cand"), low.alias("low"), high.alias("high"),
            log.alias("attempts"),
        ).cast(_STATE)

    def step(s: Column, _: Column) -> Column:
        cand, low, high = s["cand"], s["low"], s["high"]
        mb = estimate(cand)
        fits = mb <= F.col("memory_limit_mb")
        over = F.format_string(OVER_TEXT, mb, F.col("memory_limit_mb"))
        log = F.concat(
            s["attempts"],
            F.array(
                F.struct(
                    (F.size(s["attempts"]) + 1).alias("attempt"),
                    cand.alias("duration_s"),
                    mb.alias("estimated_vram_mb"),
                    fits.alias("fits"),
                    F.when(fits, F.lit(FITS_TEXT)).otherwise(over).alias("reason"),
                )
            ),
        )
        shrinking = (s["phase"] == "shrink") & ~fits
        can_shrink = shrinking & (cand > tol)
        # The first guess that fits keeps the whole span above it open; after
        # shrinking, the guess before is known not to fit.
        new_low = F.when(fits, cand).when(shrinking & (cand <= tol), tol).otherwise(low)
        new_high = F.when(fits, high).otherwise(cand)
        wide = (new_high - new_low) > tol
        phase = (
            F.when(can_shrink, F.lit("shrink"))
            .when(wide, F.lit("bisect"))
            .otherwise(F.lit("done"))
        )
        following = F.when(can_shrink, F.greatest(tol, cand / 2)).otherwise(
            (new_high + new_low) / 2
        )
        return F.when(s["phase"] == "done", s).otherwise(
            state(phase, following, new_low, new_high, log)
        )

    start = state(
        F.lit("shrink"),
        F.least(F.lit(float(initial_s)), F.col("longest_s")),
        F.lit(0.0),
        F.col("longest_s"),
        F.array().cast(PROBE_ATTEMPTS),
    )
    # Both phases halve a span that starts no longer than the recording.
    halvings = F.ceil(F.log2(F.col("longest_s") / tol)).cast("int")
    found = rows.withColumn(
        "search", F.aggregate(F.sequence(F.lit(1), halvings * 2 + 4), start, step)
    )
    note = F.when(
        F.col("gpu_index").isNotNull(),
        F.format_string(
            DEVICE_NOTE, F.col("gpu_index"), F.col("gpu_name"), F.col("memory_limit_mb")
        ),
    ).otherwise(F.lit(NO_DEVICE_NOTE))
    return found.select(
        "recording_id",
        "audio_path",
        "gpu_index",
        "gpu_name",
        "memory_limit_mb",
        round_hundredths("search.low").alias("max_duration_s"),
        F.col("search.low").alias("search_s"),
        # The estimate is linear in the duration, which gives the bound itself.
        F.least(F.col("longest_s"), F.col("memory_limit_mb") / F.nullif(F.col("mb_per_s"), F.lit(0.0)))
        .alias("bound_s"),
        note.alias("notes"),
        F.col("search.attempts").alias("attempts"),
    )


def probe_attempts(probes: DataFrame) -> DataFrame:
    """One row per search step, as logged."""

    return probes.select(
        "recording_id", "audio_path", "gpu_index", "gpu_name", "memory_limit_mb",
        F.inline("attempts"),
    )
