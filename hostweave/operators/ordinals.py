"""Dense ordinals without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.sources.scratch import cut

#: A row's place in its partition is in the lower bits of the scan's own numbers.
PLACE = (1 << 33) - 1
#: Rows that a task sorts or gathers at most on average, so its memory doesn't grow with the table.
TASK_ROWS = 1 << 20


def tasks_for(spark: SparkSession, rows: int) -> int:
    """The session's shuffle partitions, or as many more as leave ``TASK_ROWS`` to each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", buckets: int | None = None, rows: int | None = None, distinct: bool = False) -> DataFrame:
    """Adds 0, 1, 2, ... in the order of the columns, which together should tell rows apart.

    Rows are exchanged once, in ranges over all order columns (so a hub is cut like any
    other run of rows), sorted within their range, numbered as they are written to the
    shared folder, and read from there. A range starts at the count of the ranges before
    it; those counts, one row per range, are all that is added up in one place. The
    written table also ends the lineage, so that what reads it doesn't sort again.

    There are as many ranges as ``tasks_for`` says of ``rows``, a bound that only sets sizes;
    without it, rows are counted. With ``distinct``, rows alike become one within their range.
    """
    n = buckets or tasks_for(df.sparkSession, df.count() if rows is None else rows)
    ranged = df.repartitionByRange(n, *order)
    ranged = (ranged.distinct() if distinct else ranged).sortWithinPartitions(*order)
    written = cut(ranged.withColumns({"_hw_part": F.spark_partition_id(), "_hw_place": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))}), name)
    before = Window.orderBy("_hw_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    sizes = written.groupBy("_hw_part").agg(F.count("*").alias("_hw_n"))
    starts = {r["_hw_part"]: r["_hw_start"] for r in sizes.select("_hw_part", F.coalesce(F.sum("_hw_n").over(before), F.lit(0)).alias("_hw_start")).collect()}
    table = df.sparkSession.createDataFrame(list(starts.items()), "_hw_part int, _hw_start long")
    return written.join(F.broadcast(table), "_hw_part").withColumn(name, F.col("_hw_start") + F.col("_hw_place")).drop("_hw_part", "_hw_place", "_hw_start")


def stripe(ordinal: Column, world: int, rank: int) -> Column:
    """Every ``world``-th row from ``rank`` on."""
    return ordinal % world == rank


def slice_of(ordinal: Column, total: Column | int, world: int) -> Column:
    """The rank whose contiguous slice ``[total*r//world, total*(r+1)//world)`` holds the ordinal."""
    total = F.lit(total) if isinstance(total, int) else total
    return F.floor(((ordinal + 1) * world - 1) / total).cast("long")
