"""Tables that micro-batches add to, kept in few large files.

Every batch owns a folder of its own, so a table that is fed for months has as many folders as
batches. :func:`compact` folds the batches up to a given one into a generation: a folder of large
files and a pointer file that names it with the last batch it holds. Readers take the generation
the pointer names and the batches after it, so at any moment they see each batch once:

1. the generation's folder is written, which nobody reads yet;
2. the pointer is replaced in one step: readers change over;
3. folders of batches that it holds, and older generations, are removed after ``keep`` more of
   them, as long as a reader may still have them open.

A crash between two steps leaves folders that nobody reads; the next run removes them. Batches
that run again after they were folded in write their folder anew; readers leave it out.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sonoledger.sources._files import exists, filesystem_of, publish, read_bytes, subfolders

BATCH, GENERATION, POINTER = "batch=", "generation=", "_current.json"
# Bytes of a file that a generation aims at, by the size of what it folds in.
FILE_BYTES = 128 << 20


def _batch_ids(out: str) -> list[int]:
    return sorted(int(n[len(BATCH):]) for n in subfolders(out, BATCH) if re.fullmatch(BATCH + r"\d+", n))


def _finished(out: str, batch: int) -> bool:
    return exists(f"{out}/{BATCH}{batch}/_SUCCESS")


def current(out: str) -> dict:
    """The generation in force: its folder and the last batch it holds; none at first."""

    pointer = f"{out.rstrip('/')}/{POINTER}"
    return json.loads(read_bytes(pointer)) if exists(pointer) else {"generation": None, "upto": -1, "older": []}


def _paths(out: str, held: dict, batches: list[int]) -> list[str]:
    first = [f"{out}/{held['generation']}"] if held["generation"] else []
    return first + [f"{out}/{BATCH}{b}" for b in batches if b > held["upto"] and _finished(out, b)]


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """All rows of a table of micro-batches, each once; a table without rows has to be there."""

    out = out.rstrip("/")
    held = current(out)
    return spark.read.parquet(*_paths(out, held, _batch_ids(out)))


def compact(
    spark: SparkSession, out: str, fold: Callable[[DataFrame], DataFrame] | None = None, least: int = 2, keep: int = 1,
) -> int | None:
    """Fold finished batches into a new generation; the last batch it holds, or None if there were too few.

    ``fold`` may shrink the rows, such as adding up sums; it has to give the same whether it is
    applied to rows or to its own results. The newest batch stays as it is: a query that is
    started again may repeat it. ``keep`` older generations stay for readers that are under way.
    """

    out = out.rstrip("/")
    held = current(out)
    fresh = [b for b in _batch_ids(out) if b > held["upto"] and _finished(out, b)][:-1]
    _sweep(out, held, keep)
    if len(fresh) < least:
        return None
    paths = _paths(out, held, fresh)
    rows = spark.read.parquet(*paths)
    files = max(1, -(-sum(_size(p) for p in paths) // FILE_BYTES))
    name = f"{GENERATION}{fresh[-1]}-{uuid.uuid4().hex[:8]}"
    (fold(rows) if fold else rows).repartition(files).write.parquet(f"{out}/{name}")
    older = [g for g in [*held["older"], held["generation"]] if g][-keep:] if keep else []
    now = {"generation": name, "upto": fresh[-1], "before": held["upto"], "older": older}
    publish(f"{out}/{POINTER}", json.dumps(now).encode())
    _sweep(out, now, keep)
    return fresh[-1]


def _size(path: str) -> int:
    from pyarrow import fs

    system, inner = filesystem_of(path)
    return sum(f.size or 0 for f in system.get_file_info(fs.FileSelector(inner, recursive=True)))


def _sweep(out: str, held: dict, keep: int) -> None:
    """Remove batches that are folded in, and generations that no pointer names any more.

    With ``keep`` the batches of the newest generation stay until the one after it.
    """

    system, inner = filesystem_of(out)
    upto = held.get("before", -1) if keep else held["upto"]
    for batch in _batch_ids(out):
        if batch <= upto:
            system.delete_dir(f"{inner}/{BATCH}{batch}")
    known = {held["generation"], *held["older"]}
    for name in subfolders(out, GENERATION):
        if name not in known:
            system.delete_dir(f"{inner}/{name}")
