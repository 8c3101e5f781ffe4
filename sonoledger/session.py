"""Session defaults and the shared scratch area.

Nothing here is required to use the library on an existing session; the builder
only states the settings the plans were looked at with.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    app_name: str = "sonoledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC pinned."""

    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting is read and used as it stands. Only where nothing
    is set (tests, a laptop) is a fresh local folder made and recorded.
    """

    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder name under :func:`shared_root`."""

    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(
    df: DataFrame, name: str, codec: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several reports follow from one expensive table: the result
    survives lost executors, unlike a cache, and carries no lineage. ``codec`` is for
    large tables of paths and names, which ``zstd`` writes in fewer bytes; ``options`` are the
    writer's, as for the row groups of tables with very large rows.
    """

    path = shared_dir(df.sparkSession, name)
    writer = df.write.option("compression", codec) if codec else df.write
    writer.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain file scan out when it has fewer tasks than cores.

    For costly work per row on one unsplittable file. A scan of many files or
    blocks, as on a cluster, is returned as it is: no shuffle is added there.
    Only for frames without a shuffle, whose task count is known from planning.
    """

    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
