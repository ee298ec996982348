"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Only a local master may go without: it gets a temporary folder. On a cluster such a
    folder would be another one on each machine, so there a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(spark, "_hw_shared", None)
        if not found:
            found = "file://" + tempfile.mkdtemp(prefix="hostweave-")
            spark._hw_shared = found
    return found.rstrip("/")


#: The folder of the run that is going on in this thread, if what it writes here goes with it.
_RUN: ContextVar[str | None] = ContextVar("hostweave_run", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or f'{shared_dir(spark)}/hostweave'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What is written here within the block goes when it ends; a block within it shares its folder.

    For work whose result is stored elsewhere by then. A DataFrame that is handed out still
    reads its tables, so queries don't use it.
    """
    if held := _RUN.get():
        yield held
        return
    path = f"{shared_dir(spark)}/hostweave/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and reread it: ends the lineage there.

    The written table survives lost executors, is compressed and columnar, and is
    computed once (an RDD checkpoint would run the plan twice).
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
