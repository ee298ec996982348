"""The engine's verbs, from shards on disk to published artifacts."""

from __future__ import annotations

import functools
import platform
from collections.abc import Callable, Sequence

import pyspark
from pyspark.sql import DataFrame, SparkSession

import hostweave
from hostweave.functions import suffixes
from hostweave.operators import contract, graph, releases, split, training
from hostweave.sources import export, npy, registry, scratch, shards, store

Spec = str | Sequence[str]


def _stores(verb: Callable) -> Callable:
    """A verb whose result is stored when it returns: its own intermediate tables go then."""

    @functools.wraps(verb)
    def run(*args, **named):
        with scratch.run_folder(SparkSession.active()):
            return verb(*args, **named)

    return run


def info() -> dict[str, str]:
    """Versions of the engine and what it runs on."""
    return {"hostweave": hostweave.__version__, "pyspark": pyspark.__version__, "python": platform.python_version()}


@_stores
def min_degree_slice(spark: SparkSession, vertices: Spec, edges: Spec, out: str, min_degree: int = 8, num_nodes: int = 0, degree_cache: str | None = None) -> dict:
    """Shards to the stored subgraph of nodes of at least that degree; returns its metadata.

    The id map is stored beside it (``idmap``: original and compact ids). ``degree_cache``
    names a table of degrees: read where it exists, else written, so that slices at other
    degrees don't count all edges again.
    """
    if min_degree < 1:
        raise ValueError("min_degree must be at least 1")
    n = num_nodes or shards.count_lines(spark, vertices)
    full = graph.HostGraph.from_edges(shards.read_edges(spark, edges), n, shards.read_vertices(spark, vertices))
    degree = store.cached_table(spark, degree_cache, full.degrees) if degree_cache else None
    part, ids = graph.min_degree_slice(full, min_degree, degree)
    ids.write.mode("overwrite").parquet(f"{out}/idmap")
    return store.save_graph(part, out, min_degree=min_degree, source_num_nodes=n, source_vertices=str(vertices), source_edges=str(edges))


@_stores
def degree_distribution(spark: SparkSession, edges: Spec, num_nodes: int, out: str | None = None, edge_coverage: bool = False) -> dict:
    """Totals, retention ladder and histogram as one document, written where asked for."""
    found = graph.degree_report(shards.read_edges_unordered(spark, edges), num_nodes, edge_coverage)
    order = {"retention": "min_degree", "degree_histogram": "deg_lo"}
    report = found["totals"].first().asDict() | {k: [r.asDict() for r in found[k].orderBy(by).collect()] for k, by in order.items()}
    if out:
        store.write_document(spark, out, report)
    return report


@_stores
def split_cache(spark: SparkSession, folder: str, out: str, seed: int = 42, eval_edges: int = 2_000_000, max_edges: int = 0) -> dict:
    """A stored graph's edges as a stored split; returns its metadata."""
    found = store.load_graph(spark, folder)
    return store.save_split(split.split_edges(found.edges, found.num_nodes, seed, eval_edges, max_edges), out)


@_stores
def release_manifest(spark: SparkSession, folder: str, out: str, release_id: str, source_crawls: list[str] | str, reversed_host: bool = True, suffix_list: str | None = None) -> DataFrame:
    """Host records of a stored graph, stored as a release manifest; ``suffix_list`` names a file of suffix rules."""
    crawls = releases.check_crawls(source_crawls)
    found = store.load_graph(spark, folder)
    if found.nodes is None:
        raise ValueError("the graph has no names")
    rows = releases.records(found.nodes, found.degrees(), reversed_host, rules=suffixes.suffix_rules(spark, suffix_list))
    store.save_manifest(rows, out, release_id, crawls, num_hosts=found.num_nodes)
    return store.load_manifest(spark, out)[1]


def cross_release_index(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Lifecycle of keys over stored manifests, oldest first."""
    found = [store.load_manifest(spark, f) for f in folders]
    return releases.release_index([(head["release_id"], rows) for head, rows in found])


def release_sizing(spark: SparkSession, host_nodes: int = contract.HOST_NODES, domain_nodes: int = contract.DOMAIN_NODES, dims: tuple[int, ...] = contract.DIMS, precisions: tuple[str, ...] = tuple(contract.PRECISIONS)) -> dict[str, DataFrame]:
    return {"host": contract.size_table(spark, host_nodes, dims, precisions), "domain": contract.size_table(spark, domain_nodes, dims, precisions)}


@_stores
def train(spark: SparkSession, split_folder: str, out: str, config: training.Config = training.Config()) -> tuple[DataFrame, list[dict]]:
    """Embeddings from a stored split, the best epoch by validation; stored as ``out/table``."""
    found = store.load_split(spark, split_folder)
    table, history = training.train_embeddings(found.part("train"), found.num_nodes, config, f"{out}/run", found.part("val"))
    store.write_embeddings(table, f"{out}/table")
    store.write_document(spark, f"{out}/meta.json", {"encoder": "shallow", "history": history, "best_val_mrr": max((h.get("mrr", 0.0) for h in history), default=0.0)})
    return spark.read.parquet(f"{out}/table"), history


@_stores
def shard_export(vectors: DataFrame | str, names: DataFrame | Spec, out: str, release_id: str, source_crawls: list[str] | str, model_space_version: str, suffix_list: str | None = None, **options) -> dict:
    """Vectors ``(row_id, embedding)`` and names ``(row_id, name)`` as checksummed shards.

    Vectors may also be the path of an ``.npy`` matrix and names that of a text file (or
    several) with a name on each line; a row's number joins them.
    """
    spark = SparkSession.active()
    if isinstance(vectors, str):
        registry.register(spark, npy, npy.NpySource)
        vectors = spark.read.format("npy").option("path", vectors).load().withColumnRenamed("id", "row_id")
    if not isinstance(names, DataFrame):
        names = shards.read_vertices(spark, names, check=False).withColumnRenamed("id", "row_id")
    return export.export_shards(vectors, names, out, release_id, source_crawls, model_space_version, rules=suffixes.suffix_rules(spark, suffix_list), **options)
