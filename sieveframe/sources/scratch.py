"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTLED: list[str] = []
_PLACE = "_place"
_SMALL = 1 << 20  # bytes of a table that one task reads whole
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below spark.checkpoint.dir.

    The setting names storage that every executor can reach and that outlives
    any of them. Without it only a local session gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = _local_folder()
    return f"{base.rstrip('/')}/sieveframe/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sieveframe-")


@contextlib.contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes at the end all intermediate tables that were settled inside."""
    outer, _SETTLED[:] = _SETTLED[:], []
    try:
        yield
    finally:
        for path in _SETTLED:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            system.delete(target, True)
        _SETTLED[:] = outer


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a table once and go on from the files.

    For results that several later steps read: they are computed one time, a
    lost executor costs a re-read and not a recomputation, and Spark knows the
    size of the files when it chooses a join. The shuffle files of the write go
    when it ends.
    """
    return _written(df, label)[0]


def settle_small(df: DataFrame, label: str = "table") -> DataFrame:
    """Like settle() for a table of groups, which is mostly small.

    If its files hold 1 MB at most, one task reads them all, and Spark needs no shuffle,
    and so no job of its own, for each aggregate, window or sort over them. A larger
    table is read like any other.
    """
    settled, path = _written(df, label)
    return settled.coalesce(1) if _bytes(df.sparkSession, path) <= _SMALL else settled


def settle_ordered(df: DataFrame, label: str = "table") -> DataFrame:
    """Like settle() for a sorted result, which stays sorted when read again.

    A result that fits one small file is read in its order. The parts of a larger sorted
    table follow each other, so a number that grows along them keeps the order.
    """
    placed = settle_small(df.withColumn(_PLACE, F.monotonically_increasing_id()), label)
    files = placed.inputFiles()
    if len(files) == 1 and _bytes(df.sparkSession, files[0]) <= _SMALL:
        return placed.drop(_PLACE)
    return placed.orderBy(_PLACE).drop(_PLACE)


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_folder(df.sparkSession, label)
    _SETTLED.append(path)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files when they end.

    Nothing reads those again, but Spark keeps them until the driver happens to collect
    its garbage, so the disk would have to hold the shuffles of many steps at once.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _bytes(spark: SparkSession, path: str) -> int:
    """Length of a file, or of all files in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength()


def settle_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Each table of results written once, under its own name."""
    return {name: settle_small(df, name) for name, df in tables.items()}
