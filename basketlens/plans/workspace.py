"""Intermediates written to the folder every executor can reach.

A written table cuts lineage, survives the loss of any executor, and has a row count that is read from
file footers. The folder is the session's ``spark.checkpoint.dir``; only a local session without that
setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; also makes sure ML estimators can checkpoint."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if folder is None and current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="basketlens-")
    if current is None:
        sc.setCheckpointDir(folder)
    return folder or current


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/basketlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's part of the shared folder."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a scan of the written files.

    ``files`` is for a caller who knows how little there is: no more tasks and files than that, however many partitions
    ``df`` has. Each file costs calls of its own, on a local file system two processes that set its permissions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if files is None else df.coalesce(max(1, files))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Seconds after which shuffle files that nothing refers to any more are deleted, in long loops of jobs.
RELEASE_SECONDS = 10.0


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files and cached blocks that nothing refers to any more go while the body runs, not at the end of the session.

    Spark deletes them once the driver has collected its garbage, which a driver with room does by itself every half hour only.
    """
    done = threading.Event()
    system = spark.sparkContext._jvm.System

    def release() -> None:
        while not done.wait(RELEASE_SECONDS):
            system.gc()

    releasing = threading.Thread(target=release, daemon=True)
    releasing.start()
    try:
        yield
    finally:
        done.set()
        releasing.join()
        system.gc()


def drop_written(df: DataFrame) -> None:
    """Delete the files behind a DataFrame returned by :func:`written`."""
    spark = df.sparkSession
    root = _session_dir(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root not in folder:
            raise ValueError(f"{folder} is not a written intermediate")
        _delete(spark, folder)


def drop_session(spark: SparkSession) -> None:
    """Delete all intermediates of this session; for the end of a job."""
    _delete(spark, _session_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
