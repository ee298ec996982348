"""The release artifact's fields and its size model, both as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The artifact's fields in order, as name, type, place, role and bytes (0: not of a fixed width).
FIELDS = (
    ("release_id", "str", "header", "meta", 0),
    ("source_crawls", "list[str]", "header", "meta", 0),
    ("model_space_version", "str", "header", "meta", 0),
    ("host_or_domain_key", "str", "row_default", "key", 0),
    ("release_local_node_id", "uint32", "row_default", "scalar", 4),
    ("embedding", "float32", "row_default", "vector", 0),
    ("confidence_bucket", "uint8", "row_default", "scalar", 1),
    ("feature_availability", "uint8", "row_default", "scalar", 1),
    ("in_degree", "uint32", "row_default", "scalar", 4),
    ("out_degree", "uint32", "row_default", "scalar", 4),
    ("is_dangling", "uint8", "row_default", "scalar", 1),
    ("component_bucket", "uint8", "row_default", "scalar", 1),
    ("pagerank", "float32", "row_default", "scalar", 4),
    ("harmonic_centrality", "float32", "row_default", "scalar", 4),
    ("reverse_pagerank", "float32", "row_sidecar", "scalar", 4),
    ("source_role_embedding", "float32", "row_sidecar", "vector", 0),
    ("target_role_embedding", "float32", "row_sidecar", "vector", 0),
    ("scc_id", "uint32", "row_sidecar", "scalar", 4),
)
PLACES = ("header", "row_default", "row_sidecar")
# By precision the bytes a value and the compressed share of vectors; the compressed share of the rest.
PRECISIONS = {"fp32": (4, 0.95), "fp16": (2, 0.95), "int8": (1, 0.70)}
REST_SHARE = 0.45
AVG_KEY_BYTES = 24
HOST_NODES, DOMAIN_NODES = 262_351_908, 135_000_000
DIMS = (64, 128, 256)
GIB = 1 << 30


def fields(spark: SparkSession, *places: str) -> DataFrame:
    """``(name, dtype, place, role, nbytes)`` of the fields at the places (all by default)."""
    if odd := set(places) - set(PLACES):
        raise ValueError(f"no such place: {sorted(odd)}")
    every = spark.createDataFrame(FIELDS, "name string, dtype string, place string, role string, nbytes int")
    return every.where(F.col("place").isin(*places)) if places else every


def widths(spark: SparkSession) -> DataFrame:
    """``(place, n, bytes)``: the fields of each place and their fixed widths together."""
    return fields(spark).groupBy("place").agg(F.count("*").alias("n"), F.sum("nbytes").alias("bytes"))


def size_table(spark: SparkSession, num_nodes: int, dims: Sequence[int] = DIMS, precisions: Sequence[str] = tuple(PRECISIONS), avg_key_bytes: int = AVG_KEY_BYTES) -> DataFrame:
    """Plain and estimated compressed bytes of the artifact, a row for each dimension and precision.

    The sizes are one expression over a planned grid. What can't be sized is an error
    before anything runs.
    """
    wrong = [f"precision {p!r}" for p in precisions if p not in PRECISIONS] + [f"size {x}" for x in (num_nodes, *dims) if x < 1]
    if wrong:
        raise ValueError(f"can't size {', '.join(wrong)}; precisions are {', '.join(PRECISIONS)} and sizes positive")
    kinds = F.array(*[F.struct(F.lit(p).alias("precision"), F.lit(PRECISIONS[p][0]).alias("width"), F.lit(PRECISIONS[p][1]).alias("share")) for p in precisions])
    grid = spark.range(1).select(F.explode(F.array(*map(F.lit, dims))).alias("dim"), F.lit(num_nodes).cast("long").alias("num_nodes")).select("num_nodes", "dim", F.explode(kinds).alias("kind")).select("num_nodes", "dim", "kind.*")
    fixed = sum(nbytes for _, _, place, _, nbytes in FIELDS if place == "row_default")
    sized = grid.withColumns({"vector_bytes": F.col("num_nodes") * F.col("dim") * F.col("width"), "metadata_bytes": F.col("num_nodes") * F.lit(avg_key_bytes + fixed)})
    return sized.select(
        "num_nodes",
        "dim",
        "precision",
        "vector_bytes",
        "metadata_bytes",
        (F.col("vector_bytes") + F.col("metadata_bytes")).alias("total_uncompressed"),
        F.bround(F.col("vector_bytes") * F.col("share") + F.col("metadata_bytes") * F.lit(REST_SHARE)).cast("long").alias("total_compressed"),
        (F.col("vector_bytes") / GIB).alias("vector_gib"),
        ((F.col("vector_bytes") + F.col("metadata_bytes")) / GIB).alias("total_uncompressed_gib"),
    )


def format_table(table: DataFrame) -> str:
    """The size table as text, a heading and a line a row."""
    columns = {"dim": F.col("dim").cast("string"), "precision": F.col("precision"), "vectors GiB": F.format_number("vector_gib", 1), "total GiB": F.format_number("total_uncompressed_gib", 1), "compressed GiB": F.format_number(F.col("total_compressed") / GIB, 1)}
    padded = [F.lpad(c, max(6, len(name)), " ") for name, c in columns.items()]
    rows = table.orderBy("dim", "precision").select(F.concat_ws("  ", *padded).alias("line")).collect()  # a row for each size asked for
    return "\n".join(["  ".join(f"{name:>6}" for name in columns), *(r["line"] for r in rows)])
