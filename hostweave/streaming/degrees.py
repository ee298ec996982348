"""Extension: degrees over edge shards as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def edge_stream(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    """Edges of Parquet files ``(src, dst)`` that appear in a folder."""
    return spark.readStream.schema("src long, dst long").option("maxFilesPerTrigger", max_files).parquet(folder)


def running_degrees(edges: DataFrame) -> DataFrame:
    """``(id, in_degree, out_degree, degree)`` so far; for update or complete output."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("o")))).alias("e")).select("e.id", "e.o")
    return ends.groupBy("id").agg((F.count("*") - F.sum("o")).alias("in_degree"), F.sum("o").alias("out_degree"), F.count("*").alias("degree"))
