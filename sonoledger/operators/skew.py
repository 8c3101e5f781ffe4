"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of the lookup side. Eight bring a key with a third of all rows down to
# about four percent per task; adaptive execution splits further where needed.
SALTS = 8


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows to a narrow lookup with rows of one key dealt out over tasks.

    ``right`` is small in rows next to ``left`` and reduced to one row per key;
    each of its rows is repeated per salt. The salt of a left row is a hash of
    ``spread_by``, so a repeated task makes the same choice. NULL keys, which
    never match, are spread too.

    This holds whatever the session's adaptive settings are; with them on, what is
    still too large is split further, and a lookup that turns out small is
    broadcast by its real size.
    """

    if how not in ("left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")
