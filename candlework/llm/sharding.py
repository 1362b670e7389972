"""Shards of near equal bytes: global prefix sums from totals per partition.

Column expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlework.session import stored

SHARDS = 24
#: Bytes that each row takes besides its text.
OVERHEAD = 8


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard and slot.

    Rows in order of doc_id, repeated ids in order of reading, nulls first, form one
    line of bytes that is cut at ``shards`` equal targets: a row belongs to the shard in
    which its middle lies, so shards are contiguous and differ from the target by the
    rows at their two cuts at most. ``slot`` counts the rows of a shard from 0. A null
    text has no bytes and the checksum of no bytes. With few rows shards may be empty.
    """
    text = F.coalesce("text", F.lit(""))
    # The number of reading keeps copies of a row apart, so that no id is too large for a task.
    sizes = (
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
        .withColumn("reading", F.monotonically_increasing_id())
    )
    dealt = sizes.repartitionByRange("doc_id", "reading").sortWithinPartitions("doc_id", "reading")
    # Written, as the bounds of the ranges must not change between the passes below.
    rows = stored(dealt.withColumn("part", F.spark_partition_id()), "sized")
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # One row per partition, whatever the number of documents.
    before = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(line), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(line), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    own = Window.partitionBy("part").orderBy("doc_id", "reading")
    placed = (
        rows.join(F.broadcast(before), "part")
        .withColumn("place", F.col("rows_before") + F.row_number().over(own) - 1)
        .withColumn("end", F.col("bytes_before") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "shard",
            # Twice the middle, so that it is whole.
            F.floor((2 * F.col("end") - F.col("size")).cast("decimal(38,0)") * shards / (2 * F.col("total"))).cast("int"),
        )
    )
    placed = placed.select("doc_id", "size", "text_crc32", "reading", "place", "shard")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"), "reading"
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 8) -> None:
    """``docs`` as Parquet, a folder per shard, rows of each file in order of ``slot``.

    A shard is spread over ``files_per_shard`` tasks.
    """
    numbered = docs.withColumn("reading", F.monotonically_increasing_id())
    places = assign_shards(docs, shards).select("reading", "shard", "slot")
    (
        numbered.join(places, "reading")
        .drop("reading")
        .withColumn("part", F.pmod("slot", F.lit(files_per_shard)))
        .repartition("shard", "part")
        .sortWithinPartitions("shard", "part", "slot")
        .drop("part")
        .write.partitionBy("shard")
        .parquet(path)
    )


def shard_digest(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
