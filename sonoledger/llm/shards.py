"""Sharding [native]: contiguous shards of nearly equal bytes, from global prefix sums.

Rows are put in one global order by range partitioning. Each range adds up its own
rows; the running totals of the ranges, one row per range, give every row its place
in bytes and rows; shards are cut at equal byte targets. Only DataFrame functions.

Cases: a null text has size 1 (no bytes, plus 1); null ids come first; rows equal in id
and text share their places in any order; an empty table gives no rows. Other columns
of the input are left out of the plan, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.session import materialise

SHARDS = 16


def byte_shards(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    A row belongs to the shard in whose equal share of all bytes its middle lies, so
    shards are contiguous in id order and differ from an equal share by less than
    one row. ``ranges`` is the number of ranges sorted on their own; it defaults to
    the session's shuffle partitions.

    Ranges are cut on (id, checksum, size), so a run of rows with one id is split too.
    The range number of each row is written to the shared folder once: a repeated
    task then can't deal rows out differently.
    """

    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(
        narrow.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("range_no", F.spark_partition_id()),
        "shard-ranges",
    )
    # One row per range; these few rows are all that meets in one task.
    totals = dealt.groupBy("range_no").agg(F.sum("size").alias("range_bytes"), F.count("*").alias("range_rows"))
    ahead = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "range_no",
        F.coalesce(F.sum("range_bytes").over(ahead), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("range_rows").over(ahead), F.lit(0)).alias("rows_ahead"),
        F.sum("range_bytes").over(whole).alias("all_bytes"),
    )
    inside = Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Bounded by the number of ranges, not by rows.
    placed = (
        dealt.select("*", F.sum("size").over(inside).alias("_upto"), F.count("*").over(inside).alias("_nth"))
        .join(F.broadcast(starts), "range_no")
        .select(
            "doc_id", "size", "text_crc32",
            (F.col("rows_ahead") + F.col("_nth") - 1).alias("_row"),
            F.expr(
                f"least({shards - 1}, (2 * (bytes_ahead + _upto) - size) * {shards} div (2 * all_bytes))"
            ).cast("int").alias("shard"),
        )
    )
    placed = materialise(placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
