"""Tolerant parsing, fallbacks, time axis and memory arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a decimal number: digit groups may be joined by single
# underscores, a trailing type letter is not a number, infinities are not either.
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
)
_NUMBER_CHARS = "0123456789+-.eE "

# Fixed values.
MIN_BUCKET_MINUTES = 1
MS_PER_MINUTE = 60_000
FLOAT_BYTES = 4
MEMORY_OVERHEAD = 1.35
BYTES_PER_MIB = 1024**2
MEMORY_SHARE = 0.8
FALLBACK_LIMIT_MB = 4096.0


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tolerant_double(value: Column | str) -> Column:
    """Text to DOUBLE; anything that is not a finite decimal number is NULL."""

    text = _col(value).cast("string")
    # Nearly all text holds number characters only, and then the cast alone
    # decides; the pattern is left for the rest.
    usual = F.translate(text, _NUMBER_CHARS, "") == ""
    grouped = F.regexp_replace(F.trim(text), "_", "")
    return F.when(usual, text.try_cast("double")).when(
        text.rlike(_NUMBER), grouped.try_cast("double")
    )


def tolerant_long(value: Column | str) -> Column:
    """Text to BIGINT through DOUBLE, truncating toward zero; bad text is NULL."""

    return tolerant_double(value).try_cast("bigint")


def seconds_to_ms(value: Column | str) -> Column:
    """Seconds as text to whole milliseconds, truncating toward zero."""

    return (tolerant_double(value) * F.lit(1000)).try_cast("bigint")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def first_text(*values: Column | str) -> Column:
    """First value that is neither NULL nor empty."""

    return F.coalesce(*[blank_to_null(v) for v in values])


def absolute_time(chunk_start: Column | str, relative: Column | str) -> Column:
    """Offset from the recording start; NULL as soon as either part is."""

    return _col(chunk_start) + _col(relative)


def chunk_key(stem: Column | str, start: Column, end: Column, infix: str = "_chunk_") -> Column:
    """``<stem>_chunk_<start>_<end>`` or, with ``infix='_'``, ``<stem>_<start>_<end>``."""

    return F.concat(
        _col(stem), F.lit(infix), start.cast("string"), F.lit("_"), end.cast("string")
    )


def bucket_minutes_floor(minutes: int) -> int:
    return max(MIN_BUCKET_MINUTES, int(minutes))


def bucket_index(chunk_start: Column | str, minutes: int) -> Column:
    """Index of the fixed-width bucket a chunk start falls into (NULL counts as 0)."""

    width = bucket_minutes_floor(minutes) * MS_PER_MINUTE
    return F.floor(F.coalesce(_col(chunk_start), F.lit(0)) / F.lit(width)).cast("bigint")


def bucket_label(index: Column | str) -> Column:
    return F.concat(F.lit("bucket_"), _col(index).cast("string"))


def memory_estimate_mb(
    duration_s: Column, sample_rate: Column | str, channels: Column | str, width: Column | str
) -> Column:
    """Working memory (MiB) of a window once its samples are widened to floats."""

    bytes_per_second = (
        _col(sample_rate).cast("double") * _col(channels) * _col(width) * F.lit(FLOAT_BYTES)
    )
    return bytes_per_second * duration_s * F.lit(MEMORY_OVERHEAD) / F.lit(float(BYTES_PER_MIB))


def memory_limit_mb(memory_total_mb: Column | str) -> Column:
    """Usable share of a device; a fallback budget where no device is known."""

    total = _col(memory_total_mb)
    return F.coalesce(
        F.when(total.isNotNull(), F.greatest(F.lit(1.0), total * F.lit(MEMORY_SHARE))),
        F.lit(FALLBACK_LIMIT_MB),
    )


def round_hundredths(value: Column | str) -> Column:
    """Round a non-negative DOUBLE to two places by its exact binary value.

    The built-in rounds the shortest decimal text, so 67.725 goes up although the
    stored number lies below it. Here the fraction is split in halves whose
    products are exact, which leaves the comparison with one half free of error;
    true ties go to the even digit.
    """

    v = _col(value)
    whole = F.floor(v)
    part = v - whole
    high = F.floor(part * F.lit(2.0**26)) / F.lit(2.0**26)
    near = F.floor(part * 100 + F.lit(0.5))
    off = (high * 100 - near) + (part - high) * 100
    odd = near % 2 == 1
    step = (
        F.when((off > 0.5) | ((off == 0.5) & odd), 1)
        .when((off < -0.5) | ((off == -0.5) & odd), -1)
        .otherwise(0)
    )
    return (whole * 100 + near + step) / F.lit(100.0)
