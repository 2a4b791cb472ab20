"""Session settings and shared scratch space."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``, or the application with
    ``setCheckpointDir``. Only where neither is set (tests, one machine) is a
    local folder made, one per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="annoflow-")
    return _LOCAL_ROOTS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    return posixpath.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def temporary_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in scratch space, deleted as ``written`` says."""
    path = scratch_path(spark, name)
    blocks = _TEMPORARY.get()
    if keep:
        blocks = blocks[:-1]
    if blocks:
        blocks[-1].append(path)
    return path


def written(
    df: DataFrame, name: str, partition_by: str | None = None, keep: bool = False, compression: str | None = None
) -> DataFrame:
    """Write ``df`` to scratch space as Parquet and read it back.

    Used where a later step must see exactly the rows an earlier step saw
    (sampled range bounds, user code that may not repeat itself), also after an
    executor is lost. Inside ``temporary_tables`` the table goes at the end of the block; with
    ``keep`` it outlives the block, as a block's result has to, and goes with the next one around it.
    ``compression`` is Parquet's, the session's if none is given.
    """
    path = temporary_path(df.sparkSession, name, keep)
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path, partitionBy=partition_by, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written go when it is there; else they would lie on the
    executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


#: The tables to delete of each block that is open, the innermost last.
_TEMPORARY: ContextVar[tuple[list[str], ...]] = ContextVar("temporary tables", default=())


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``written`` writes in between, through the Hadoop
    file system that holds it."""
    held: list[str] = []
    token = _TEMPORARY.set((*_TEMPORARY.get(), held))
    try:
        yield
    finally:
        _TEMPORARY.reset(token)
        for path in held:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
