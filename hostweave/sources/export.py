"""Checksummed Parquet shards of vectors with host keys, and their manifest."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostweave.functions.identity import forward_host
from hostweave.functions.suffixes import SuffixRules, with_domain
from hostweave.operators.releases import check_crawls
from hostweave.operators.vectors import input_norms, normalized
from hostweave.sources import shardfiles
from hostweave.sources.registry import register
from hostweave.sources.store import jsonable, read_document

# The tiers' folders and types, the manifest's version and keys, and the metrics that it takes over.
TIERS = {"fp32": {"vectors": "float32"}, "fp16": {"vectors": "float16"}, "both": {"vectors": "float32", "vectors_fp16": "float16"}}
FORMAT = 1
METRICS = frozenset(("best_val_mrr", "test_mrr", "test_hits@1", "test_hits@10"))
#: What the manifest says of each column.
COLUMNS = {
    "row_id": "64-bit integer; counts the release's rows from 0, a shard holds the next rows_per_shard of them",
    "host_key": "text; the host name, most general label last, by which releases are joined",
    "domain_key": "text; the public suffix of the host and the label before it",
    "embedding": "list of dim values of the type named under precisions",
}
ENTRY = "kind string, shard long, filename string, row_start long, row_end long, n_rows long, bytes long, sha256 string"


def check_aligned(vectors: DataFrame, names: DataFrame) -> None:
    """Row ids of vectors and names must be the same set."""
    odd = vectors.select("row_id", F.lit(1).alias("v")).join(names.select("row_id", F.lit(1).alias("n")), "row_id", "full_outer").where("v IS NULL OR n IS NULL").first()
    if odd:
        what = "names without a vector" if odd["v"] is None else "vectors without a name"
        raise ValueError(f"names and vectors are misaligned: {what}, first row {odd['row_id']}")


def rows_of(vectors: DataFrame, names: DataFrame, normalize: bool = True, reverse: bool = True, rules: SuffixRules | None = None) -> DataFrame:
    """``(row_id, host_key, domain_key, embedding)`` from ``(row_id, embedding)`` and ``(row_id, name)``."""
    vector = normalized(F.col("embedding")) if normalize else F.col("embedding")
    keyed = with_domain(names.select("row_id", forward_host(F.col("name"), reverse).alias("host_key")), rules)
    return vectors.join(keyed, "row_id").select("row_id", "host_key", "domain_key", vector.alias("embedding"))


def export_shards(vectors: DataFrame, names: DataFrame, folder: str, release_id: str, crawls: list[str] | str, space: str, rows_per_shard: int = 4_000_000, precision: str = "both", normalize: bool = True, reverse: bool = True, limit: int = 0, meta: dict[str, Any] | None = None, rules: SuffixRules | None = None) -> dict:
    """Writes shards and ``manifest.json``; returns the manifest.

    Rows are dealt and sorted by shard and streamed: a task writes a shard row group by row
    group and holds one batch. Files get their names, and the manifest is written, when all
    tasks are done (see ``shardfiles``). ``folder`` may be in any store that Arrow opens.
    ``limit`` exports the rows below it.
    """
    if precision not in TIERS:
        raise ValueError(f"unknown precision {precision!r}; one of {sorted(TIERS)}")
    crawls = check_crawls(crawls)
    spark, tiers = vectors.sparkSession, TIERS[precision]
    if limit > 0:
        vectors, names = vectors.where(F.col("row_id") < limit), names.where(F.col("row_id") < limit)
    check_aligned(vectors, names)
    n, low, high = vectors.agg(F.count("*"), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high:
        raise ValueError(f"vectors of different lengths: {low} to {high}")
    shards = -(-n // rows_per_shard)
    told = dict(meta or {})
    manifest = {
        "schema_version": FORMAT,
        "model_space_version": space,
        "release_id": release_id,
        "source_crawls": crawls,
        "encoder": told.get("encoder"),
        "dim": low,
        "num_rows": n,
        "rows_per_shard": rows_per_shard,
        "num_shards": shards,
        "distance": "cosine",
        "normalized": normalize,
        "input_norm_min_mean_max": [*input_norms(vectors).first()],
        "columns": COLUMNS,
        "canonical_precision": next(iter(tiers.values())),
        "precisions": tiers,
        "metrics": {name: told[name] for name in sorted(told.keys() & METRICS)},
        "shards": [],
    }
    rows = rows_of(vectors, names, normalize, reverse, rules).select(F.floor(F.col("row_id") / rows_per_shard).cast("long").alias("shard"), "row_id", "host_key", "domain_key", "embedding")
    dealt = rows.repartition(max(1, shards), "shard").sortWithinPartitions("shard", "row_id")
    register(spark, shardfiles, shardfiles.ShardSink)
    options = {"path": folder, "tiers": json.dumps(tiers), "shards": str(shards), "rows": str(n), "manifest": json.dumps(jsonable(manifest))}
    dealt.write.format(shardfiles.FORMAT_NAME).mode("append").options(**options).save()
    return read_document(spark, f"{folder}/manifest.json" if "://" in folder else f"file://{folder}/manifest.json")
