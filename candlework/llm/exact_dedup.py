"""Exact duplicates: a persistent index of text digests, bucketed and sorted by digest.

Data arrives in deliveries. The texts of one are grouped by digest before anything else
is done with them, so a text of any number of copies is one row. A sort-merge anti-join
with the index finds the digests that are new; they are appended. The index lies on disk
as the join needs it, so only the delivery is shuffled, never the index.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlework.session import stored

#: Parts of the index. Fixed when it is created: some 200 MB of digests each is right.
BUCKETS = 64
#: A text of more than this share of all rows is joined by broadcast: there are fewer than so many.
HOT_SHARE = 1024
#: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def digested(docs: DataFrame) -> DataFrame:
    """``doc_id, points, digest, row`` of every row of ``docs``; store it before use.

    ``points`` counts the code points of the text as it is, ``digest`` is of the
    normalised one, ``row`` tells repeated rows apart.
    """
    return docs.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("points"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


def _best(*more: str) -> Column:
    """The row that stays: most code points, smallest id, those without one last."""
    return F.min(
        F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *more)
    )


class DigestIndex:
    """The index below ``path``, a folder that all executors share.

    One row per digest and delivery: the delivery's row that stays, the number of its
    rows, and whether the digest was ``fresh``, that is, in no earlier delivery. Each
    delivery is a folder of its own, and adding it again replaces it.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.path, self.id_type, self.buckets = spark, path, id_type, buckets
        self.table = "digests_" + hashlib.md5(path.encode()).hexdigest()
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, points INT, doc_id {id_type}, row BIGINT,"
            " n BIGINT, fresh BOOLEAN, delivery STRING) USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"
            f" PARTITIONED BY (delivery) CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            f" LOCATION '{place}'"
        )
        # What an earlier session has written is on disk but unknown to this one.
        spark.range(0).write.mode("ignore").parquet(path)
        spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def entries(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def add(self, rows: DataFrame, delivery: str) -> DataFrame:
        """Adds ``digested`` rows; returns the entries whose digests no earlier delivery has.

        Of these texts one row each stays, which makes them the delivery's new data. An
        empty delivery adds nothing.
        """
        groups = (
            rows.groupBy("digest")
            .agg(_best("row").alias("best"), F.count(F.lit(1)).alias("n"))
            .select("digest", (-F.col("best.less")).alias("points"), "best.doc_id", "best.row", "n")
            .repartition(self.buckets, "digest")
        )
        known = self.entries().where(F.col("delivery") != delivery).select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti").withColumn("fresh", F.lit(True))
        again = groups.join(known, "digest", "left_semi").withColumn("fresh", F.lit(False))
        # By the bucket's own number: one file each, whatever the number of tasks.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        added = fresh.unionByName(again).repartition(self.buckets, bucket)
        added.withColumn("delivery", F.lit(delivery)).write.insertInto(self.table, overwrite=True)
        return self.entries().where((F.col("delivery") == delivery) & F.col("fresh"))

    def groups(self) -> DataFrame:
        """One row per digest: the row that stays of all deliveries, and the number of rows. No shuffle."""
        return (
            self.entries()
            .groupBy("digest")
            .agg(_best("delivery", "row").alias("best"), F.sum("n").alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.delivery").alias("keep_delivery"),
                    F.col("best.row").alias("keep_row"), "group_size")
        )


def judged(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of ``rows``, which are ``digested`` rows with their ``delivery``, all added.

    Returns ``doc_id``, ``keep_id`` (of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256`` of the normalised text. Of equal texts the row with the most code
    points stays, then the smallest id, rows without an id last, then the first delivery
    and row; so of repeated rows exactly one is kept. Null is the empty text.

    Texts of more than 1 / ``HOT_SHARE`` of all rows are few, and joined where their rows
    are; all others by a shuffle.
    """
    groups = index.groups()
    limit = rows.count() // HOT_SHARE
    hot = F.broadcast(groups.where(F.col("group_size") > limit))
    few = rows.join(hot, "digest")
    many = rows.join(hot.select("digest"), "digest", "left_anti").join(
        groups.where(F.col("group_size") <= limit), "digest"
    )
    here = (F.col("delivery") == F.col("keep_delivery")) & (F.col("row") == F.col("keep_row"))
    return few.unionByName(many).select(
        "doc_id", "keep_id", "group_size", here.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicated(docs: DataFrame, index: DigestIndex, delivery: str) -> DataFrame:
    """The rows of ``docs``, all their columns, whose texts no earlier delivery has: one of each text.

    ``docs`` has to be stored: it is read twice, and its rows are told apart by their places.
    """
    rows = stored(digested(docs), "digests")
    fresh = index.add(rows, delivery).select("digest", "row")
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    return numbered.join(fresh.select(F.col("row").alias("__row")), "__row", "left_semi").drop("__row")
