"""Which dataset a file belongs to."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.functions.paths import ancestors, directory, tidy_path
from sonoledger.operators.skew import spread_join


# Fixed value: the folder that marks a dataset's root.
MARKER = ".datalad"


def find_dataset_roots(rows: DataFrame, path_col: str, marker: str = MARKER) -> DataFrame:
    """Folders at or above the paths of ``path_col`` that hold ``marker``, as ``dataset_root``.

    Each folder is looked at once, in the tasks, on any filesystem Arrow knows. A folder
    that cannot be looked at is no root.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            found = []
            for folder in batch["folder"]:
                try:
                    system, inner = (
                        fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
                    )
                    if system.get_file_info(f"{inner}/{marker}").type != fs.FileType.NotFound:
                        found.append(folder)
                except (OSError, ValueError):
                    continue
            yield pd.DataFrame({"dataset_root": found}, dtype=object)

    paths = rows.filter(F.col(path_col).isNotNull()).select(tidy_path(path_col).alias("path")).distinct()
    folders = paths.select(F.explode(ancestors("path")).alias("folder")).distinct()
    return folders.mapInPandas(look, "dataset_root string")


def attach_dataset_root(
    rows: DataFrame, roots: DataFrame, path_col: str, out_col: str = "dataset_root"
) -> DataFrame:
    """Nearest root at or above each path; NULL where no root encloses it.

    ``roots`` has one column ``dataset_root``. The search runs once per distinct
    folder, not per row: folders are deduplicated inside the tasks first, spread
    over their ancestors and equi-joined with the roots.
    """

    folder = directory(F.col(path_col))
    folders = (
        rows.filter(F.col(path_col).isNotNull())
        .select(folder.alias("_folder"))
        .distinct()
    )
    roots = roots.groupBy(tidy_path("dataset_root").alias("_above")).agg(
        F.min(F.rtrim("dataset_root", F.lit("/"))).alias("_root")
    )
    nearest = (
        folders.withColumn("_above", F.explode(ancestors("_folder")))
        .join(roots, "_above")
        .groupBy("_folder")
        .agg(F.max_by("_root", F.length("_above")).alias(out_col))
    )
    placed = rows.withColumn("_folder", folder)
    return spread_join(placed, nearest, "_folder", [path_col]).drop("_folder")
