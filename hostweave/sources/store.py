"""Graphs, splits and manifests on disk, small documents, and run folders."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.operators.graph import HostGraph
from hostweave.operators.ordinals import tasks_for
from hostweave.operators.releases import RECORD, check_crawls
from hostweave.operators.split import Split


def jsonable(x: Any) -> Any:
    """Arrays to lists, scalars to values, everything unknown to text."""
    if isinstance(x, dict):
        return {str(k): jsonable(v) for k, v in x.items()}
    if isinstance(x, (list, tuple, set)):
        return [jsonable(v) for v in x]
    if hasattr(x, "tolist"):
        return x.tolist()
    return x if isinstance(x, (str, int, float, bool)) or x is None else str(x)


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """A small JSON document, in any store that Spark writes to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray((json.dumps(jsonable(document), indent=2) + "\n").encode()))
    finally:
        out.close()


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def cached_table(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at the path; where there is none (or no whole one), it is made and written first."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: The columns by which a bucketed graph's two tables of edges are dealt.
ENDS = ("src", "dst")


def _bucketed(spark: SparkSession, folder: str, key: str, buckets: int) -> DataFrame:
    """The stored edges by one end, as a table whose buckets the planner knows."""
    name = f"hw_graph_{hashlib.md5(folder.encode()).hexdigest()}_{key}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (eid BIGINT, src BIGINT, dst BIGINT) USING parquet CLUSTERED BY ({key}) SORTED BY (eid) INTO {buckets} BUCKETS LOCATION '{folder}/edges-by-{key}'")
    return spark.table(name)


def save_graph(graph: HostGraph, folder: str, buckets: int = 0, **provenance: Any) -> dict:
    """Edges, ``nodes`` (where there are any) and ``meta.json``.

    Edges are one table in ranges of ordinals; or, with ``buckets``, two tables dealt by
    source and by target, each sorted by ordinal, over which degrees and neighbour lists
    need no exchange of edges.
    """
    spark = graph.edges.sparkSession
    if buckets:
        for key in ENDS:
            name = f"hw_save_{uuid.uuid4().hex}"
            rows = graph.edges.select("eid", "src", "dst").repartition(buckets, key)  # a task writes one bucket
            rows.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy("eid").option("path", f"{folder}/edges-by-{key}").saveAsTable(name)
            spark.sql(f"DROP TABLE {name}")  # its files stay
    else:
        graph.edges.repartitionByRange(tasks_for(spark, graph.num_edges() if graph.about is None else graph.about), "eid").sortWithinPartitions("eid").write.mode("overwrite").parquet(f"{folder}/edges")
    if graph.nodes is not None:
        graph.nodes.repartitionByRange(tasks_for(spark, graph.num_nodes), "id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{folder}/nodes")
    stored = spark.read.parquet(f"{folder}/edges-by-src" if buckets else f"{folder}/edges")
    meta = {"num_nodes": graph.num_nodes, "num_edges": stored.count(), "has_nodes": graph.nodes is not None, "buckets": buckets, **provenance}
    write_document(spark, f"{folder}/meta.json", meta)
    return meta


def load_graph(spark: SparkSession, folder: str) -> HostGraph:
    meta = read_document(spark, f"{folder}/meta.json")
    nodes = spark.read.parquet(f"{folder}/nodes") if meta["has_nodes"] else None
    if meta.get("buckets"):
        by_src, by_dst = (_bucketed(spark, folder, key, meta["buckets"]) for key in ENDS)
        return HostGraph(by_src, meta["num_nodes"], nodes, by_dst)
    return HostGraph(spark.read.parquet(f"{folder}/edges"), meta["num_nodes"], nodes)


def save_split(split: Split, folder: str) -> dict:
    """Edges in one folder per split, so that readers prune, and ``split_meta.json``.

    Training edges lie in order of their ordinals, over files and within them, so a worker
    that asks for its slice reads the row groups that hold it.
    """
    spark = split.edges.sparkSession
    order = ["split", "train_ordinal", "eid"]
    split.edges.repartitionByRange(tasks_for(spark, split.num_edges), *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("split").parquet(f"{folder}/edges")
    stored = Split(spark.read.parquet(f"{folder}/edges"), split.num_nodes, split.num_edges, split.seed, split.eval_edges)
    meta = stored.meta()
    write_document(spark, f"{folder}/split_meta.json", meta)
    return meta


def load_split(spark: SparkSession, folder: str) -> Split:
    meta = read_document(spark, f"{folder}/split_meta.json")
    return Split(spark.read.parquet(f"{folder}/edges"), meta["num_nodes"], meta["n_edges"], meta["seed"], meta["eval_edges"])


def save_manifest(records: DataFrame, folder: str, release_id: str, crawls: list[str], **header: Any) -> None:
    """``hosts`` as TSV with a header line, columns in the fixed order, and ``manifest.json``."""
    spark = records.sparkSession
    records.select(*RECORD).write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{folder}/hosts")
    write_document(spark, f"{folder}/manifest.json", {"release_id": release_id, "source_crawls": check_crawls(crawls), **header})


def load_manifest(spark: SparkSession, folder: str) -> tuple[dict, DataFrame]:
    kinds = "host_key string, domain_key string, local_node_id long, in_degree long, out_degree long, is_dangling int, cohort string, confidence string"
    return read_document(spark, f"{folder}/manifest.json"), spark.read.schema(kinds).option("sep", "\t").option("header", True).csv(f"{folder}/hosts")


def write_embeddings(vectors: DataFrame, folder: str) -> None:
    """The table in order of id."""
    vectors.orderBy("id").write.mode("overwrite").parquet(folder)


class RunDirectory:
    """A dated folder, in any store that Spark writes to, with a log of metrics and a pointer to the last run.

    An entry of the log is a document of its own, so nothing is ever appended to.
    """

    def __init__(self, root: str, name: str) -> None:
        self.spark = SparkSession.active()
        self.root = root.rstrip("/") if ":" in root else f"file://{root.rstrip('/')}"
        self.name = f"{time.strftime('%Y%m%d-%H%M%S')}-{name}"
        self.path, self.entries = f"{self.root}/{self.name}", 0

    def log_metrics(self, step: int, **values: Any) -> None:
        self.entries += 1
        write_document(self.spark, f"{self.path}/metrics/{self.entries:06d}.json", {"step": step, "wall_time": time.time(), **values})

    def read_metrics(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("multiLine", True).json(f"{self.path}/metrics").orderBy(F.col("step"))

    def mark_last(self) -> None:
        write_document(self.spark, f"{self.root}/LAST", {"run": self.name})
