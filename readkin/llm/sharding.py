"""Contiguous shards of near-equal bytes by global prefix sums, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_size, scratch


def assign(docs: DataFrame, shards: int = 16, tolerance: float = 0.01) -> DataFrame:
    """Put every row of ``docs(doc_id, text)`` into a shard: ``doc_id, size, text_crc32, shard, slot``.

    Rows are ordered by (CRC-32, 64-bit hash of the text, doc_id), so that equal
    texts are neighbours.  A range partitioning deals the order out (a large
    group of copies is cut by doc_id); the totals of the partitions, one row
    each, give every partition its offset, and a running sum inside the
    partition gives every row its global first byte.  The order is cut at equal
    shares of all bytes; a cut that falls inside a group of equal texts moves to
    the group's end, so that all of it is in the shard of its first row, if the whole group has at most ``tolerance`` of a shard's
    bytes; only larger groups are divided.  ``slot`` counts the rows of a
    shard from 0.

    A null text has no bytes and CRC-32 zero; a null doc_id sorts first; repeated
    rows are rows like others; an empty table gives no row; no other column is
    read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", byte_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
    dealt = scratch(rows.repartitionByRange("text_crc32", "h", "doc_id").withColumn("part", F.spark_partition_id()), "dealt")

    parts = dealt.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = parts.select("part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.sum("b").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy("text_crc32", "h", "doc_id", "size")
    ranked = dealt.select(
        "*", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b1"), F.row_number().over(inside).alias("n1")
    ).join(F.broadcast(parts), "part")
    first = F.col("b0") + F.col("b1")
    # start * shards / total without overflow or rounding: whole division of the decimal product
    cut = F.least(F.lit(shards - 1), F.floor(first.cast("decimal(28,0)") * shards / F.col("total")).cast("int"))
    placed = scratch(ranked.select("doc_id", "size", "text_crc32", "h", "total", (F.col("n0") + F.col("n1") - 1).alias("rank"), cut.alias("cut")), "placed")

    # Groups that a cut divides: at most one for each cut.
    moved = placed.groupBy("text_crc32", "h").agg(F.min("cut").alias("to"), F.max("cut").alias("last"), (F.sum("size") * shards <= F.max("total") * tolerance).alias("small")).where("last > to and small").select("text_crc32", "h", "to")
    placed = scratch(placed.join(F.broadcast(moved), ["text_crc32", "h"], "left").select("doc_id", "size", "text_crc32", "rank", F.coalesce("to", "cut").alias("shard")), "shards")
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start"))  # one row a shard
    return placed.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("start")).cast("long").alias("slot"))
