"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots. It is posted
in the inverted files of its nearest pivots; a query probes the files of its own nearest
pivots. In a file, vectors are ranked by the footrule distance (the sum of differences of
pivot ranks) to the query, the best share of their ids, with all that tie at its edge, is
ranked again by the exact distance, and the best few of each file are merged.

Pivots are a bounded sample (``PIVOTS`` vectors by a hash of id and components); every
vector is indexed. Files are cut into blocks of about ``BLOCK`` vectors by a hash of the
id, so a pivot that attracts a third of all vectors is many tasks; each block is searched
whole, none is capped. The queries of a file go to each of its blocks.

Cases: vectors that are null, zero or hold null or non-finite components, and rows with a
null id, take no part; vectors of different lengths are never compared (each length has
its own pivots); ties go to the smaller id; a repeated id is a candidate once, with its
nearest vector; fewer than ``k`` candidates are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.session import materialise

PIVOTS = 256  # at most 256: ranks are bytes
POSTED, PROBED = 4, 96
SHARE = 0.1  # of a block that is ranked again, 50 vectors at least
BLOCK = 4096
NEIGHBOURS = 10


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector, dim) of the rows that take part, as doubles."""

    v = F.col(vector_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    held = vectors.filter(
        F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    )
    return held.select(
        F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"), F.size(v).alias("dim")
    )


def _pivots(held: DataFrame, n: int) -> dict[int, np.ndarray]:
    """At most ``n`` distinct vectors of each length."""

    place = F.row_number().over(Window.partitionBy("dim").orderBy("h", "vector"))
    few = held.select("dim", "vector", F.xxhash64("vec_id", "vector").alias("h"))
    # A hash threshold first, so the window sees about eight times the sample at most.
    sizes = held.groupBy("dim").agg(F.count("*").alias("size"))
    chosen = (
        few.join(F.broadcast(sizes), "dim")  # one row per vector length
        .filter(F.pmod("h", F.lit(1 << 20)) < F.greatest(F.lit(1), F.ceil(F.lit(8.0 * n * (1 << 20)) / F.col("size"))))
        .dropDuplicates(["dim", "vector"])
        .withColumn("place", place).filter(F.col("place") <= n).orderBy("dim", "place").select("dim", "vector").collect()
    )
    out: dict[int, list] = {}
    for dim, vector in chosen:
        out.setdefault(dim, []).append(vector)
    return {dim: np.array(rows) for dim, rows in out.items()}


def _ranks(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of pivots, rank of each pivot) for rows of ``x``; ties by pivot number."""

    far = (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T  # up to a constant per row
    order = np.argsort(far, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(len(pivots)), order.shape), axis=1)
    return order, rank.astype(np.uint8)


def _posted(held: DataFrame, pivots: dict[int, np.ndarray], lists: int) -> DataFrame:
    """One row per vector and file: (dim, pivot, vec_id, vector, ranks)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.array(part["vector"].tolist(), float)
                order, rank = _ranks(x, pivots[dim])
                near = order[:, :lists]
                n = near.shape[1]
                yield pd.DataFrame({
                    "dim": np.int32(dim), "pivot": near.reshape(-1).astype(np.int32),
                    "vec_id": np.repeat(part["vec_id"].to_numpy(), n),
                    "vector": np.repeat(np.array([r.tobytes() for r in x], object), n),
                    "ranks": np.repeat(np.array([r.tobytes() for r in rank], object), n),
                })

    return held.mapInPandas(work, "dim int, pivot int, vec_id long, vector binary, ranks binary")


def _matrix(rows: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _search_block(queries: pd.DataFrame, block: pd.DataFrame, k: int, share: float) -> pd.DataFrame:
    """The best ``k`` ids of a block for each query; all ids tied at the share's edge are ranked again."""

    asked, found, scores = [], [], []
    if len(queries) and len(block):
        block = block.sort_values(["vec_id", "vector"], ignore_index=True)
        x, ranks = _matrix(block["vector"], float), _matrix(block["ranks"], np.uint8).astype(np.int16)
        # Cuts count ids, not rows: a repeated id takes one place, with its nearest row.
        ids, first, rows = np.unique(block["vec_id"].to_numpy(), return_index=True, return_counts=True)
        once = len(ids) == len(block)
        again = max(50, int(np.ceil(share * len(block))))
        for query, vector, rank in zip(queries["vec_id"], _matrix(queries["vector"], float), _matrix(queries["ranks"], np.uint8)):
            footrule = np.abs(ranks - rank.astype(np.int16)).sum(axis=1, dtype=np.int32)
            if not once:
                footrule = np.minimum.reduceat(footrule, first)
            others = ids != query
            near = np.flatnonzero(others)
            if again < len(near):
                footrule[~others] = np.iinfo(np.int32).max
                near = np.flatnonzero(footrule <= np.partition(footrule, again - 1)[again - 1])
            if not len(near):
                continue
            if once:
                distance = np.sqrt(((x[near] - vector) ** 2).sum(axis=1))
            else:
                start = np.cumsum(rows[near]) - rows[near]
                at = np.repeat(first[near] - start, rows[near]) + np.arange(rows[near].sum())
                distance = np.minimum.reduceat(np.sqrt(((x[at] - vector) ** 2).sum(axis=1)), start)
            best = np.argsort(distance, kind="stable")[:k]  # ids ascend
            asked.append(np.full(len(best), query))
            found.append(ids[near[best]])
            scores.append(distance[best])
    if not asked:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": float})
    out = pd.DataFrame({"query_id": np.concatenate(asked), "vec_id": np.concatenate(found), "score": np.concatenate(scores)})
    # A query's id may be repeated as well.
    out = out.sort_values(["query_id", "score", "vec_id"], ignore_index=True).drop_duplicates(["query_id", "vec_id"])
    return out.groupby("query_id").head(k)


def nearest(
    vectors: DataFrame, is_query, k: int = NEIGHBOURS, pivots: int = PIVOTS, posted: int = POSTED, probed: int = PROBED,
    share: float = SHARE, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found, for rows where ``is_query`` holds."""

    spark = vectors.sparkSession
    held = usable(vectors, id_col, vector_col)
    chosen = _pivots(held, pivots)
    schema = "query_id long, rank int, vec_id long, score double"
    if not chosen:
        return spark.createDataFrame([], schema)
    index = materialise(_posted(held, chosen, posted), "vectors-posted")
    asked = materialise(_posted(held.filter(is_query), chosen, probed), "vectors-asked")
    # Blocks per file: at most dim x pivots rows, small enough to send to every task.
    files = materialise(
        index.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("n")), "vectors-files"
    )
    placed = index.join(F.broadcast(files), ["dim", "pivot"]).select(
        "dim", "pivot", "vec_id", "vector", "ranks", F.pmod(F.xxhash64("vec_id"), F.col("n")).cast("int").alias("block")
    )
    sizes = files.select(F.col("dim").alias("_dim"), F.col("pivot").alias("_pivot"), F.col("n").alias("_n"))
    sent = asked.join(F.broadcast(sizes), (F.col("dim") == F.col("_dim")) & (F.col("pivot") == F.col("_pivot"))).select(
        "dim", "pivot", "vec_id", "vector", "ranks", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("block")
    )
    keys = ["dim", "pivot", "block"]
    best = sent.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(
        lambda q, b: _search_block(q, b, k, share), "query_id long, vec_id long, score double"
    )
    once = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
