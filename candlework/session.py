"""The shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The folder of the present run, below the scratch folder.
_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("run", default=None)


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="candlework-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables written between two jobs.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may go
    without: every executor then sees this machine's disk anyway.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is not None:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return "/".join(filter(None, [scratch_root(spark), _RUN.get(), f"{name}-{uuid.uuid4().hex}"]))


@contextlib.contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for one run, deleted at its end, also when the run fails.

    Everything that is ``stored`` meanwhile lies there, so results have to be written
    elsewhere by then. Runs within a run share its folder.
    """
    if (outer := _RUN.get()) is not None:
        yield f"{scratch_root(spark)}/{outer}"
        return
    name = f"run-{uuid.uuid4().hex}"
    token = _RUN.set(name)
    try:
        yield f"{scratch_root(spark)}/{name}"
    finally:
        _RUN.reset(token)
        delete_folder(spark, f"{scratch_root(spark)}/{name}")


@contextlib.contextmanager
def tasks_a_core(spark: SparkSession, setting: str, tasks: int = 4) -> Iterator[None]:
    """Meanwhile ``setting``, a number of tasks, is so many for each core.

    For work on very many files, whose tasks Spark counts by bytes or by folders. A
    setting that the session makes itself stands.
    """
    if spark.conf.get(setting, None) is not None:
        yield
        return
    spark.conf.set(setting, tasks * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(setting)


def shuffles_freed(function):
    """For functions of a DataFrame: what a query inside has shuffled is deleted as soon as the query ends.

    Otherwise it lies on the executors' disks until the driver happens to collect its
    garbage. It is for functions that store what they go on with: a query that is run
    again shuffles again. A setting that the session makes itself stands.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    @functools.wraps(function)
    def run(df: DataFrame, *args, **kwargs):
        conf = df.sparkSession.conf
        if setting in conf.getAll:
            return function(df, *args, **kwargs)
        conf.set(setting, True)
        try:
            return function(df, *args, **kwargs)
        finally:
            conf.unset(setting)

    return run


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark writes to; none is fine."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def files_below(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, modified`` of every file below ``path``, none if there is no such folder.

    Contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        return files.load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the scratch folder and read back.

    Cuts the lineage: what was computed stays as it is when executors are lost,
    and several readers see the same rows, each only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
