"""Starting vectors and the link-prediction loss of a table over mini-batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.operators.ordinals import tasks_for
from hostweave.operators.vectors import hashed_below

#: Deviation of the starting vectors' entries.
SPREAD = 0.1


def normal(*parts: Column) -> Column:
    """A standard normal number for each value of the parts, from two halves of their digest."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    unit = lambda at: (F.conv(F.substring(digest, at, 8), 16, 10).cast("double") + 0.5) / (1 << 32)
    return F.sqrt(-2 * F.log(unit(1))) * F.cos(2 * 3.141592653589793 * unit(9))


def initial_vectors(spark: SparkSession, num_nodes: int, dim: int, seed: int = 42) -> DataFrame:
    """``(id, embedding)`` with normal entries; an entry depends on its id, place and the seed only."""
    entry = lambda j: (normal(F.lit(seed), F.col("id"), j) * SPREAD).cast("float")
    return spark.range(num_nodes).select("id", F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), entry).alias("embedding"))


def batch_losses(batches: DataFrame, vectors: DataFrame, train_neg: int, seed: int = 42) -> DataFrame:
    """``(batch, n, loss)``: each batch's mean loss of its edges plus that of their negatives.

    ``batches(batch, eid, src, dst)`` are mini-batches; a null end or one without a vector is
    an error. An edge's negatives are ``train_neg`` draws, with replacement, from the distinct
    nodes of its batch in order of id, so a node that more edges touch isn't likelier than
    another. Each end asks for its vector by id; the vectors come to the batch before its
    edges in one sorted stream, and all scores are taken there, so a task holds one batch.
    """
    spark = batches.sparkSession
    tasks = tasks_for(spark, 3 * batches.count())  # a row for each edge and either end
    asked = batches.select("batch", F.explode(F.array("src", "dst")).alias("id"))
    held = vectors.select(F.col("id").cast("long").alias("id"), "embedding")
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        asked, held = asked.repartition(tasks, "id"), held.repartition(tasks, "id")
    none = F.lit(None).cast("long")
    sent = asked.join(held, "id").select("batch", F.lit(0).alias("side"), "id", none.alias("src"), none.alias("dst"), "embedding")
    edges = batches.select("batch", F.lit(1).alias("side"), F.col("eid").alias("id"), "src", "dst", F.array().cast(held.schema["embedding"].dataType).alias("embedding"))

    def loss(key: int, nodes: list[pa.RecordBatch], rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        column = lambda parts, name: np.concatenate([p.column(name).to_numpy(zero_copy_only=False) for p in parts])
        eid, src, dst = (column(rows, c) for c in ("id", "src", "dst"))
        ids, first = np.unique(column(nodes, "id") if nodes else np.zeros(0, np.int64), return_index=True)
        lost = np.setdiff1d(np.concatenate([src, dst]), ids)
        if len(lost):
            raise ValueError(f"no vector of node {lost[0]}")
        table = np.concatenate([p.column("embedding").flatten().to_numpy() for p in nodes]).reshape(sum(len(p) for p in nodes), -1)[first].astype(np.float64)
        u = table[np.searchsorted(ids, src)]
        drawn = hashed_below(eid[:, None] * train_neg + np.arange(train_neg), seed, len(ids))
        positive = np.logaddexp(0, -np.einsum("ij,ij->i", u, table[np.searchsorted(ids, dst)]))
        negative = np.logaddexp(0, np.einsum("ij,ikj->ik", u, table[drawn]))
        return pa.record_batch([pa.array([key]), pa.array([len(eid)]), pa.array([float(positive.mean() + negative.mean())])], ["batch", "n", "loss"])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, rows = None, [], []
        for part in stream:
            key = np.stack([part.column("batch").to_numpy(), part.column("side").to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if key[i, 0] != now:
                    if rows:
                        yield loss(now, nodes, rows)
                    now, nodes, rows = int(key[i, 0]), [], []
                (rows if key[i, 1] else nodes).append(part.slice(i, j - i))
        if rows:
            yield loss(now, nodes, rows)

    return sent.unionByName(edges).repartition(tasks, "batch").sortWithinPartitions("batch", "side").mapInArrow(run, "batch long, n long, loss double")


def weighted_loss(losses: DataFrame) -> DataFrame:
    """Mean of ``loss`` weighted by ``n``."""
    return losses.agg((F.sum(F.col("loss") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("loss"))
