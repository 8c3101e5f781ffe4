"""Path pieces as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_path(path: Column | str) -> Column:
    """No slash at the end and none doubled; patterns only run where one is."""

    path = F.col(path) if isinstance(path, str) else path
    single = F.when(path.contains("//"), F.regexp_replace(path, "/+", "/")).otherwise(path)
    return F.rtrim(single, F.lit("/"))


def posix_path(uri: Column | str, encoded: bool = False) -> Column:
    """Drop a ``file:`` scheme; other schemes are kept as they are.

    ``encoded`` is for scan metadata, which percent-encodes the path.
    """

    path = F.col(uri) if isinstance(uri, str) else uri
    if encoded:
        path = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.regexp_replace(path, "^file:/+", "/")


def basename(path: Column | str) -> Column:
    return F.substring_index(tidy_path(path), "/", -1)


def stem(path: Column | str) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]+$", "")


def directory(path: Column | str) -> Column:
    """Everything before the last component, without a trailing slash."""

    tidy = tidy_path(path)
    kept = F.length(tidy) - F.length(F.substring_index(tidy, "/", -1)) - 1
    return F.left(tidy, F.greatest(kept, F.lit(0)))


def parent_name(path: Column | str) -> Column:
    return F.substring_index(directory(path), "/", -1)


def ancestors(path: Column | str) -> Column:
    """The path itself and every directory above it, shortest first."""

    parts = F.split(tidy_path(path), "/")
    depths = F.sequence(F.lit(1), F.size(parts))
    joined = F.transform(depths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.filter(joined, lambda p: p != F.lit(""))
