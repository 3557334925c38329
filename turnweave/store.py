"""Tables that are written to the folder which driver and executors share, and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession

#: The session's setting by which Spark deletes a query's shuffle files when the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dir: str | None = None
#: Folders that were written inside the innermost ``scratch``.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder (as URI) that driver and executors share.

    It lies under ``spark.checkpoint.dir`` or the folder that the context was given for checkpoints. A session on one
    machine without either gets a temporary folder, which goes when the driver ends; any other raises.
    """
    global _own_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _own_dir is None:
            _own_dir = tempfile.mkdtemp(prefix="turnweave-")
            atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
        base = f"file://{_own_dir}"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    The write's shuffle files go with it; by default they lie on disk until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    if (written := _written.get()) is not None:
        written.append(path)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def gather(df: DataFrame) -> list[Row]:
    """The rows of ``df`` on the driver; the query's shuffle files go with it, as those of a write do."""
    with _shuffle_cleanup(df.sparkSession):
        return df.select("*").collect()  # a frame has the setting of the moment when it was made


@contextmanager
def _shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that ``materialize`` returned; any other is left alone."""
    if path := getattr(df, "_stored_at", None):
        remove_dir(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end, also after a failure, the tables that are materialised inside.

    What is yielded marks a table as one that stays (and returns it); an enclosing ``scratch`` then answers for it.
    Frames that still read a deleted table must not leave the block.
    """
    paths: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._stored_at)
        return df

    outer = _written.get()
    token = _written.set(paths)
    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _written.reset(token)
        for path in paths:
            if path not in kept:
                remove_dir(spark, path)
        if outer is not None:
            outer.extend(kept)


def remove_dir(spark: SparkSession, uri: str) -> None:
    """Delete a folder of the shared store through Hadoop's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
