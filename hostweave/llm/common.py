"""Helpers that the corpus operators share: shared storage, text access, batch building.

Conventions of every operator in this subpackage
* A null text counts as the empty text unless the operator says otherwise.
* Operators read only the columns they name, so extra columns (clashing names
  included) never reach them; helper columns of row-keeping operators start with
  ``_hw_`` and are dropped again.
* Nothing proportional to the corpus is collected to the driver or broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.sources.scratch import cut, shared_dir

__all__ = ["cut", "documents", "map_batches", "met", "raw", "shared_dir", "sides", "texts"]


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch as Python strings; null is the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def raw(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null is empty."""
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sides(rows: DataFrame, classes: DataFrame, keys: list[str], heavy: int, how: str, hint: str = "merge") -> tuple[DataFrame, DataFrame]:
    """Joins rows with ``classes(*keys, size)``: those of ``heavy`` rows or more, and the others.

    A class that large would be one task's load. There are at most rows / ``heavy`` of
    them, so they are broadcast; the others are dealt out by their keys.
    """
    large = F.broadcast(classes.where(F.col("size") >= heavy))
    small = classes.where(F.col("size") < heavy)
    return rows.join(large, keys, how), rows.join(large, keys, "left_anti").join(small.hint(hint), keys, how)


def met(rows: DataFrame, classes: DataFrame, keys: list[str], heavy: int, how: str) -> DataFrame:
    """Both sides of that join together."""
    large, small = sides(rows, classes, keys, heavy, how)
    return large.unionByName(small)
