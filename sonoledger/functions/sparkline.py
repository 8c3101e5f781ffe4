"""One-line text charts of short number arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SPARK_PALETTE = " .:-=+*#%@"
SPARK_WIDTH = 12
SPARK_EMPTY = "-"


def sparkline(
    values: Column | str, width: int = SPARK_WIDTH, palette: str = SPARK_PALETTE
) -> Column:
    """Thin an array to ``width`` points and draw each as one palette character.

    A flat series draws the middle character, no values draw ``-``.
    """

    series = F.col(values) if isinstance(values, str) else values
    width = max(1, width)
    top = len(palette) - 1
    size = F.size(series)
    picks = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.get(series, (i * (size / F.lit(width))).cast("int")),
    )
    points = F.when(size > width, picks).otherwise(series).cast("array<double>")
    low, high = F.array_min(points), F.array_max(points)
    span = F.nullif(high - low, F.lit(0.0))

    def glyph(v: Column) -> Column:
        level = ((v - low) / span * F.lit(top)).cast("int")
        return F.substring(F.lit(palette), F.least(F.lit(top), level) + F.lit(1), F.lit(1))

    flat = F.repeat(F.lit(palette[min(top, len(palette) // 2)]), F.size(points))
    return (
        F.when(F.coalesce(size, F.lit(0)) <= 0, F.lit(SPARK_EMPTY))
        .when(high == low, flat)
        .otherwise(F.array_join(F.transform(points, glyph), ""))
    )
