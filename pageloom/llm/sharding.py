"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are dealt to range partitions of their order, totals per partition are summed first (one row per partition),
then every partition adds its own running sums to the total before it. Only ids, sizes and digests move; texts stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageloom.session import ensure_checkpoint_dir


def with_running_totals(rows: DataFrame, order: list[str], amount: str) -> DataFrame:
    """Adds ``_before`` (sum of ``amount`` over all earlier rows), ``_index`` (number of earlier rows), ``_total``.

    Order columns must tell all rows apart, but for rows that are equal in every column: those may change places.
    The dealt rows are checkpointed, so that a task that runs again sees the ranges it saw before.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    totals = dealt.groupBy("_part").agg(F.sum(amount).alias("_sum"), F.count("*").alias("_count"))
    # one row per range partition: bounded by the number of partitions
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_count_before"),
        F.sum("_sum").over(everything).alias("_total"),
    )
    inside = W.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        dealt.join(F.broadcast(offsets), "_part")
        .withColumn("_before", F.col("_sum_before") + F.sum(amount).over(running) - F.col(amount))
        .withColumn("_index", F.col("_count_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_sum_before", "_count_before")
    )


def byte_shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, size, text_crc32, shard, slot)``, one per row of ``docs``.

    Size is the text's UTF-8 bytes plus one, a null text has no bytes. Rows stand in the order of id (nulls first),
    then digest of the text; a row goes to the shard in which the middle of its bytes falls, so every cut lies within half a row of its
    equal target. Slots count from 0 in each shard without gaps. Repeated rows share a place in the order and get
    slots of their own; a shard stays empty only if single rows are larger than a target. Empty tables give no rows.
    """
    text = F.col(text_col)
    slim = docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.xxhash64(text).alias("_digest"),
    )
    placed = with_running_totals(slim, ["_id", "text_crc32", "_digest", "size"], "size")
    shard = F.least(F.lit(n_shards - 1), F.expr(f"({n_shards} * (2 * _before + size)) div (2 * _total)")).cast("int")
    sharded = placed.withColumn("shard", shard).checkpoint()
    # one row per shard
    first = sharded.groupBy("shard").agg(F.min("_index").alias("_first"))
    return sharded.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )
