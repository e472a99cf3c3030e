"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.sources.staging import stage


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row.

    Rows are put in the order of doc_id (then checksum, size and place in the
    input) by a range partitioning. Each part's bytes and rows are summed, the
    sums' running totals give every row its global byte and row number, and
    bytes are cut at ``shards`` equal targets: a row belongs to the shard in which its
    middle byte lies, so a shard is off its target by less than its two border
    rows. ``slot`` numbers a shard's rows from 0 in that order.

    A text's size is its UTF-8 bytes plus 1; a null text has none (size 1,
    checksum 0). Rows without doc_id come first. Equal rows, also of one doc_id,
    are placed each; shards may be empty if there are few rows, and there are no
    rows without documents. Texts are read once and never shuffled; what is
    broadcast has a row for each part or shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    order = ["doc_id", "text_crc32", "size", "_row"]
    parts = stage(sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        parts.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(whole).alias("_all_bytes"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("_upto", upto).withColumn("_nth", F.row_number().over(inside))
    middle = "(2 * (_bytes_before + _upto) - size)"
    numbered = stage(
        placed.join(F.broadcast(totals), "_part").select(
            "doc_id",
            "size",
            "text_crc32",
            F.expr(f"int({shards}L * {middle} div (2 * _all_bytes))").alias("shard"),
            (F.col("_rows_before") + F.col("_nth") - 1).alias("_index"),
        )
    )
    first = numbered.groupBy("shard").agg(F.min("_index").alias("_first"))
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )
