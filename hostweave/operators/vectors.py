"""Vector columns: norms, ranking against random nodes, ranking metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostweave.functions.hashing import MULTIPLIER, hash_mod


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalized(v: Column) -> Column:
    """The vector over its length; an all-zero vector stays."""
    return F.element_at(F.transform(F.array(norm(v)), lambda n: F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float"))).otherwise(v)), 1)


def input_norms(vectors: DataFrame, rows: int = 4096, id_col: str = "row_id") -> DataFrame:
    """Least, mean and greatest length of the leading rows."""
    n = norm(F.col("embedding"))
    return vectors.where(F.col(id_col) < rows).agg(F.min(n).alias("norm_min"), F.avg(n).alias("norm_mean"), F.max(n).alias("norm_max"))


#: Positives of one batch of a ranking; its task holds the vectors of their ends and negatives.
RANK_BATCH = 512


def hashed_below(x: np.ndarray, seed: int, n: int) -> np.ndarray:
    """``hash_mod`` of non-negative integers, in numpy."""
    with np.errstate(over="ignore"):
        return (((x.astype(np.uint64) + np.uint64(seed)) * np.uint64(MULTIPLIER)) % np.uint64(n)).astype(np.int64)


def ranked(positives: DataFrame, vectors: DataFrame, num_nodes: int, negatives: int = 100, seed: int = 42, digits: int = 6, batch: int = RANK_BATCH) -> DataFrame:
    """``(eid, rank)``: 1 and the number of uniform random nodes that score above the true one.

    Negatives are drawn with replacement by a hash, unfiltered; ties favour the true one.
    Positives fall into batches. A batch asks once for each node that it needs, by id; the
    vectors come to the batch once, before its positives in one sorted stream, and all
    scores are taken there. Positives whose ends lack a vector, and negatives that do, go.
    """
    batches = max(1, -(-positives.count() // batch))
    edges = positives.select(F.pmod(F.xxhash64("eid"), F.lit(batches)).alias("batch"), "eid", F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    drawn = F.transform(F.sequence(F.lit(0), F.lit(negatives - 1)), lambda k: hash_mod(F.col("eid") * negatives + k, seed, num_nodes))
    asked = edges.select("batch", F.explode(F.concat(F.array("src", "dst"), drawn)).alias("id")).distinct()
    sent = asked.join(vectors.select(F.col("id").cast("long").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")).where("v IS NOT NULL"), "id")
    none = F.lit(None).cast("long")
    rows = sent.select("batch", F.lit(0).alias("side"), "id", none.alias("src"), none.alias("dst"), "v").unionByName(edges.select("batch", F.lit(1).alias("side"), F.col("eid").alias("id"), "src", "dst", F.array().cast("array<double>").alias("v")))

    def score(ids: np.ndarray, table: np.ndarray, eid: np.ndarray, src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
        place = lambda x: np.minimum(np.searchsorted(ids, x), len(ids) - 1)
        here = (ids[place(src)] == src) & (ids[place(dst)] == dst)
        eid, src, dst = eid[here], src[here], dst[here]
        neg = hashed_below(eid[:, None] * negatives + np.arange(negatives), seed, num_nodes)
        at = place(neg)
        u = table[place(src)]
        pos = np.round(np.einsum("ij,ij->i", u, table[place(dst)]), digits)
        above = (np.round(np.einsum("ij,ikj->ik", u, table[at]), digits) > pos[:, None]) & (ids[at] == neg)
        return pa.record_batch([pa.array(eid), pa.array(1 + above.sum(axis=1))], ["eid", "rank"])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, table = None, [], []
        for part in stream:
            key = np.stack([part.column("batch").to_numpy(), part.column("side").to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                some = part.slice(i, j - i)
                if key[i, 0] != now:
                    now, ids, table = key[i, 0], [], []
                if key[i, 1] == 0:
                    ids.append(some.column("id").to_numpy())
                    table.append(some.column("v").flatten().to_numpy().reshape(j - i, -1))
                elif ids:
                    ids, table = [np.concatenate(ids)], [np.concatenate(table)]
                    for a in range(0, j - i, 64):
                        eid, src, dst = (some.column(c).slice(a, 64).to_numpy() for c in ("id", "src", "dst"))
                        yield score(ids[0], table[0], eid, src, dst)

    return rows.repartition("batch").sortWithinPartitions("batch", "side", "id").mapInArrow(run, "eid long, rank long")


def ranking_metrics(ranks: DataFrame) -> DataFrame:
    hits = lambda k: F.avg((F.col("rank") <= k).cast("double"))
    return ranks.agg(F.avg(1 / F.col("rank")).alias("mrr"), hits(1).alias("hits_1"), hits(10).alias("hits_10"))


def eval_mrr(positives: DataFrame, vectors: DataFrame, num_nodes: int, negatives: int = 100, seed: int = 42) -> DataFrame:
    """Mean reciprocal rank and hits at 1 and 10, one row."""
    return ranking_metrics(ranked(positives, vectors, num_nodes, negatives, seed))
