"""Text shards: resolving, reading with global ordinals, vertices and edges; writing links as shards."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.operators.ordinals import TASK_ROWS
from hostweave.sources.scratch import cut


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths by Hadoop's file systems, so that any store Spark reads will do."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found] if found else []


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and from its root on."""
    plain = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(plain).toString()


def resolve(spark: SparkSession, spec: str | Sequence[str]) -> list[str]:
    """Files of a path, glob, folder (its ``.gz`` files, else all), or list of these.

    Sorted within each item; the list's order stays. No file at all is an error.
    """
    out: list[str] = []
    for item in [spec] if isinstance(spec, str) else list(spec):
        if any(c in item for c in "*?["):
            out += sorted(_glob(spark, item))
            continue
        inside = [p for p in _glob(spark, item.rstrip("/") + "/*") if not p.rsplit("/", 1)[-1].startswith((".", "_"))]
        if inside:
            out += sorted([p for p in inside if p.endswith(".gz")] or inside)
        else:
            out.append(_qualified(spark, item))
    if not out:
        raise FileNotFoundError(f"no shard matches {spec!r}")
    return out


def _kept(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(value, file, block, mark)`` of the non-blank lines; marks count up within a task."""
    meta = F.col("_metadata")
    raw = spark.read.text(files).select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))
    return raw.where(F.col("value").rlike(r"\S")).withColumn("mark", F.monotonically_increasing_id())


def _name(path: str) -> str:
    """A path without its scheme, which the list and the scan may write differently."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def block_index(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, block, n, first, start)``, stored: each file block's lines, its first mark, and the lines before it.

    One row per file block is all that is brought into one order.
    """
    counted = cut(_kept(spark, files).groupBy("file", "block").agg(F.count("*").alias("n"), F.min("mark").alias("first")), "line-counts")
    place = {_name(f): i for i, f in enumerate(files)}
    names = [r[0] for r in counted.select("file").distinct().collect()]  # some of the files listed above
    order = spark.createDataFrame([(f, place[_name(unquote(f))]) for f in names], "file string, place int")
    before = Window.orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    return cut(counted.join(order, "file").select("file", "block", "n", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "line-index")


#: A line index of more file blocks than this is left to the optimiser instead of broadcast.
BROADCAST_BLOCKS = 1 << 20


def lines(spark: SparkSession, spec: str | Sequence[str]) -> DataFrame:
    """``(ordinal, value)`` of the non-blank lines, counted over the files in order.

    A first scan counts the lines of each file block; in the second a line's number is its
    block's start and its place since the block's first mark, so no line is exchanged or
    sorted. Compressed files are one block each and are read by as many tasks as there are
    files. Marks are alike in both scans as long as the files and the settings by which they
    are dealt to tasks are; a mark outside its block is an error.
    """
    files = resolve(spark, spec)
    index = block_index(spark, files)
    index = F.broadcast(index) if index.count() <= BROADCAST_BLOCKS else index
    at = F.col("mark") - F.col("first")
    wrong = F.raise_error(F.concat(F.lit("lines aren't where they were counted: "), F.col("file"))).cast("long")
    return _kept(spark, files).join(index, ["file", "block"]).select(F.when((at < 0) | (at >= F.col("n")), wrong).otherwise(F.col("start") + at).alias("ordinal"), "value")


def count_lines(spark: SparkSession, spec: str | Sequence[str]) -> int:
    """Non-blank lines: the bound of vertex ids."""
    return spark.read.text(resolve(spark, spec)).where(F.col("value").rlike(r"\S")).count()


def read_vertices(spark: SparkSession, spec: str | Sequence[str], check: bool = True) -> DataFrame:
    """``(id, name)``: the id is the line's ordinal; the name is the second field, or the only one.

    With ``check``, a written id that differs from the ordinal is an error when read.
    """
    part = F.split("value", "\t")
    rows = lines(spark, spec).select(F.col("ordinal").alias("id"), part.alias("p"))
    named = rows.select("id", F.when(F.size("p") > 1, F.element_at("p", 2)).otherwise(F.element_at("p", 1)).alias("name"), F.when(F.size("p") > 1, F.element_at("p", 1).try_cast("long")).alias("written"))
    if check:
        bad = F.raise_error(F.concat(F.lit("vertex id differs from its line: "), F.col("written").cast("string")))
        named = named.withColumn("id", F.when(F.col("written").isNotNull() & (F.col("written") != F.col("id")), bad.cast("long")).otherwise(F.col("id")))
    return named.select("id", "name")


def read_edges(spark: SparkSession, spec: str | Sequence[str], lenient: bool = False, max_edges: int = 0) -> DataFrame:
    """``(eid, src, dst)`` of tab-separated lines; ``lenient`` splits at any white space."""
    part = F.split(F.trim("value"), r"\s+" if lenient else "\t")
    rows = lines(spark, spec)
    if max_edges > 0:
        rows = rows.where(F.col("ordinal") < max_edges)
    return rows.select(F.col("ordinal").alias("eid"), F.element_at(part, 1).cast("long").alias("src"), F.element_at(part, 2).cast("long").alias("dst"))


def read_edges_unordered(spark: SparkSession, spec: str | Sequence[str]) -> DataFrame:
    """``(src, dst)`` by the CSV reader, failing on malformed lines; for order-free work."""
    return spark.read.schema("src long, dst long").option("sep", "\t").option("mode", "FAILFAST").csv(resolve(spark, spec))


def write_lines(rows: DataFrame, folder: str, order: str, line: Column, files: int = 2, compression: str = "gzip") -> None:
    """A line for each row, in the order of a column over all files.

    There are ``files`` of them, or as many more as leave ``TASK_ROWS`` to each: a file is one
    task's sort, and if it is compressed also one task's read.
    """
    files = max(files, -(-rows.count() // TASK_ROWS))
    rows.repartitionByRange(files, order).sortWithinPartitions(order).select(line.alias("value")).write.mode("overwrite").option("compression", compression).text(folder)
