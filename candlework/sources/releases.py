"""Tables that change together: folders of slices, and one small file that says which count.

Below the root lie

    <table>/run=<run>/slice=<value>/part-*     what a run has written, never changed again
    releases/release=<number>/part-*           one file: for each slice, the run that counts

A run writes its slices, then the release's file, which appears at once by a single
rename. Until then readers see the release before, whole, in all tables; what a stopped
run has left is not named by any release and is written over by the next. One run at a
time may write.

Slices may be bucketed: rows of one key then lie in the files of one bucket, the same in
all slices and tables of that number of buckets. ``Releases.table`` reads them so that
windows, groups and joins by the key need no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.session import delete_folder, files_below

RECORDS_PER_FILE = 5_000_000
_RELEASE = "table string, slice string, run long, buckets int"


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The values of the folders ``<name>=<value>`` that hold the files below ``path``."""
    value = F.regexp_extract("path", "=([^=/]*)/[^/]*$", 1)
    return sorted(r[0] for r in files_below(spark, path).select(value).distinct().collect())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(map(int, _folders(spark, f"{root}/releases")))


class Releases:
    """The tables below ``root``, as of the latest release when this was made.

    The list of slices is held by the driver: tables have a slice for each month, bucket
    or run, whatever the number of rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.number = max(_numbers(spark, root), default=0)
        #: (table, slice) -> run
        self.slices: dict[tuple[str, str], int] = {}
        #: table -> number of buckets
        self.buckets: dict[str, int] = {}
        if self.number:
            rows = spark.read.schema(_RELEASE).json(self._release(self.number)).collect()
            self.slices = {(r["table"], r["slice"]): r["run"] for r in rows}
            self.buckets = {r["table"]: r["buckets"] for r in rows if r["buckets"]}

    def _release(self, number: int) -> str:
        return f"{self.root}/releases/release={number}"

    def slices_of(self, table: str) -> list[str]:
        return sorted(s for t, s in self.slices if t == table)

    def read(self, table: str, schema: T.StructType, kind: T.DataType, only: Iterable[Any] | None = None) -> DataFrame:
        """The table with its ``slice``, of type ``kind``; of the slices in ``only`` where given.

        Other slices are not opened, nor listed. A table without slices is empty.
        """
        wanted = None if only is None else {str(s) for s in only}
        folders = [
            f"{self.root}/{table}/run={run}/slice={s}"
            for (t, s), run in sorted(self.slices.items())
            if t == table and (wanted is None or s in wanted)
        ]
        whole = T.StructType([*schema.fields, T.StructField("slice", kind)])
        if not folders:
            return self.spark.createDataFrame([], whole)
        files = self.spark.read.schema(whole).option("basePath", f"{self.root}/{table}").parquet(*folders)
        return files.select(*whole.fieldNames())

    def table(self, table: str, schema: T.StructType, kind: T.DataType, key: str, buckets: int) -> DataFrame:
        """The table as ``read`` returns it, written in ``buckets`` by ``key``, known to be so.

        It is named in the session's catalog, once for each release. Another number of
        buckets than it was written with is an error: rows would be missed.
        """
        self.check_buckets(table, buckets)
        place = hashlib.md5(f"{self.root}/{table}".encode()).hexdigest()
        name = f"released_{place}_{self.number}"
        if not self.spark.catalog.tableExists(name):
            fields = [*schema.fields, T.StructField("slice", kind)]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (slice)"
                f" CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{_quoted(f'{self.root}/{table}')}'"
            )
            parts = [
                f"PARTITION (slice = '{s}') LOCATION '{_quoted(f'{self.root}/{table}/run={run}/slice={s}')}'"
                for (t, s), run in sorted(self.slices.items())
                if t == table
            ]
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts)}")
        return self.spark.read.table(name)

    def check_buckets(self, table: str, buckets: int) -> None:
        if self.slices_of(table) and self.buckets.get(table, 0) != buckets:
            raise ValueError(f"{table} is stored in {self.buckets.get(table, 0)} buckets, not {buckets}")

    def next_run(self) -> Run:
        return Run(self)


class Run:
    """What one run writes. Nothing of it is seen before ``publish``."""

    def __init__(self, base: Releases):
        self.base, self.number = base, base.number + 1
        self.spark, self.root = base.spark, base.root
        #: (table, slice) -> run, of all that the release is going to hold
        self.slices, self.buckets = dict(base.slices), dict(base.buckets)

    def clear(self, table: str) -> None:
        """Leaves out what earlier releases hold of the table."""
        self.slices = {(t, s): run for (t, s), run in self.slices.items() if t != table}
        self.buckets.pop(table, None)

    def write(
        self, df: DataFrame, table: str, slice_of: Column, *order: str, key: str | None = None, buckets: int = 0
    ) -> list[str]:
        """Writes ``df`` as the new content of its slices, sorted by ``order``; returns these slices.

        The slices of ``df`` have to be whole: they replace those of earlier releases.
        With a ``key`` they are bucketed by it.
        """
        self._as_released().check_buckets(table, buckets)
        path = f"{self.root}/{table}/run={self.number}"
        rows = df.withColumn("slice", slice_of)
        if key is None:
            rows = rows.hint("rebalance", F.col("slice")).sortWithinPartitions("slice", *order)
        else:
            # By the number of the bucket: one file of each in a slice of ordinary size.
            rows = rows.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
            rows = rows.hint("rebalance", F.col("slice"), F.col("_bucket")).drop("_bucket")
        writer = (
            rows.write.format("parquet")
            .mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("maxRecordsPerFile", RECORDS_PER_FILE)
            .partitionBy("slice")
        )
        if key is None:
            writer.save(path)
        else:
            # Only a named table can be bucketed; the name goes, the files stay.
            name = "written_" + hashlib.md5(path.encode()).hexdigest()
            writer.option("path", path).bucketBy(buckets, key).sortBy(*order).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
        found = _folders(self.spark, path)
        self.slices.update({(table, s): self.number for s in found})
        if buckets:
            self.buckets[table] = buckets
        return found

    def read(self, table: str, schema: T.StructType, kind: T.DataType, only: Iterable[Any] | None = None) -> DataFrame:
        """As ``Releases.read``, with what this run has written in place."""
        return self._as_released().read(table, schema, kind, only)

    def _as_released(self) -> Releases:
        seen = object.__new__(Releases)
        seen.spark, seen.root, seen.number = self.spark, self.root, self.number
        seen.slices, seen.buckets = dict(self.slices), dict(self.buckets)
        return seen

    def publish(self) -> Releases:
        """Makes all that was written the latest release, in one step."""
        rows = [(t, s, run, self.buckets.get(t, 0)) for (t, s), run in sorted(self.slices.items())]
        release = self.spark.createDataFrame(rows, _RELEASE).coalesce(1)
        release.write.mode("error").json(self.base._release(self.number))
        return self._as_released()


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes all but the last ``keep`` releases, and the slices that only those name.

    Readers that opened one of the kept releases are not disturbed. Returns the folders.
    """
    numbers = _numbers(spark, root)
    kept, old = numbers[-keep:], numbers[:-keep]

    def named(release: int) -> set[tuple[str, str, int]]:
        rows = spark.read.schema(_RELEASE).json(f"{root}/releases/release={release}").collect()
        return {(r["table"], r["slice"], r["run"]) for r in rows}

    needed = {x for n in kept for x in named(n)}
    folders = [
        f"{root}/{table}/run={run}/slice={s}"
        for table, s, run in sorted({x for n in old for x in named(n)} - needed)
    ]
    # The releases go first, so that none is left that names a slice which is gone.
    folders = [f"{root}/releases/release={n}" for n in old] + folders
    for folder in folders:
        delete_folder(spark, folder)
    return folders
