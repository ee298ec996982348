"""Deterministic train/validation/test splits, held-out samples and worker shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.functions.hashing import SEED_STEP, eval_keep, hash_mod, keep_fraction, split_bucket, split_name
from hostweave.operators.ordinals import slice_of, with_ordinal
from hostweave.sources.scratch import cut


@dataclass(frozen=True)
class Split:
    """Edges with a column ``split``; training edges have a ``train_ordinal``."""

    edges: DataFrame
    num_nodes: int
    num_edges: int
    seed: int
    eval_edges: int

    def part(self, name: str) -> DataFrame:
        return self.edges.where(F.col("split") == name)

    def meta(self) -> dict[str, int]:
        counts = {r["split"]: r["count"] for r in self.edges.groupBy("split").count().collect()}
        return {"num_nodes": self.num_nodes, "n_edges": self.num_edges, "train_total": counts.get("train", 0), "val_count": counts.get("val", 0), "test_count": counts.get("test", 0), "seed": self.seed, "eval_edges": self.eval_edges}


def assigned(edges: DataFrame, seed: int = 42) -> DataFrame:
    """Adds ``bucket`` and ``split``; depends on the edge's ordinal and the seed only."""
    return edges.withColumn("bucket", split_bucket(F.col("eid"), seed)).withColumn("split", split_name(F.col("eid"), seed))


def _kept(total: int, seed: int, cap: int) -> Column:
    share = keep_fraction(total, cap)
    keep = F.col("split") == "train"
    for name, step in SEED_STEP.items():
        keep = keep | (F.col("split") == name) & eval_keep(F.col("eid"), share, seed + step)
    return keep


def bounded(split_edges: DataFrame, total: int, seed: int = 42, cap: int = 2_000_000) -> DataFrame:
    """Drops held-out edges beyond the sample of about 1.5 times the cap; training edges stay."""
    return split_edges.where(_kept(total, seed, cap))


def split_edges(edges: DataFrame, num_nodes: int, seed: int = 42, eval_edges: int = 2_000_000, max_edges: int = 0) -> Split:
    """Hash split, held-out sample and training ordinals.

    Hashes are taken once, as the marked edges are written: filters over hashes, which each
    reader would repeat, become methods too long to be compiled.
    """
    used = edges if max_edges <= 0 else edges.where(F.col("eid") < max_edges)
    n = used.count()
    marked = cut(assigned(used, seed).withColumn("_hw_kept", _kept(n, seed, eval_edges)), "marked")
    parts = marked.where("_hw_kept").drop("_hw_kept")
    train = with_ordinal(parts.where("split = 'train'"), ["eid"], "train_ordinal", rows=n)
    rest = parts.where("split <> 'train'").withColumn("train_ordinal", F.lit(None).cast("long"))
    return Split(train.unionByName(rest), num_nodes, n, seed, eval_edges)


def worker_stripes(split: Split, world: int) -> DataFrame:
    """Training edges with the worker that takes every ``world``-th."""
    return split.part("train").withColumn("rank", F.col("train_ordinal") % world)


def worker_slices(split: Split, world: int, train_total: int | None = None) -> DataFrame:
    """Training edges with the worker whose contiguous, balanced slice they are in."""
    total = split.part("train").count() if train_total is None else train_total
    return split.part("train").withColumn("rank", slice_of(F.col("train_ordinal"), total, world))


def worker_slice(split: Split, world: int, rank: int, train_total: int | None = None) -> DataFrame:
    """One worker's contiguous slice, as a range of ordinals that the scan of a stored split prunes by."""
    total = split.part("train").count() if train_total is None else train_total
    return split.part("train").where((F.col("train_ordinal") >= total * rank // world) & (F.col("train_ordinal") < total * (rank + 1) // world))


#: Bits of a hash by which one pass of a selection tells groups apart, and bits of the hash.
STEP, MARK = 13, 39


def subsample(edges: DataFrame, cap: int, seed: int = 42) -> DataFrame:
    """Exactly ``cap`` edges by least hash (all if there are no more or ``cap`` is 0).

    No task sorts or holds the sample: counts by the hash's upper bits, at most ``2 ** STEP``
    rows, show in which group the last one is, and further passes refine that group until
    the bound is known; then a filter takes all up to it. Of equal hashes, which only ids
    ``2 ** MARK`` apart can have, the least ids count.
    """
    if cap <= 0:
        return edges
    marked = edges.withColumn("_hw_mark", hash_mod(F.col("eid"), seed, 1 << MARK))
    mark, prefix, left = F.col("_hw_mark"), 0, cap
    for bits in range(MARK - STEP, -1, -STEP):
        inside = marked.where(F.shiftright(mark, bits + STEP) == prefix)
        counts = sorted((r["at"], r["n"]) for r in inside.groupBy(F.shiftright(mark, bits).alias("at")).agg(F.count("*").alias("n")).collect())
        for at, n in counts:
            if left <= n:
                prefix = at
                break
            left -= n
        else:
            return edges  # there are no more
        if left == n:
            return marked.where(F.shiftright(mark, bits) <= prefix).drop("_hw_mark")
    last = marked.where(mark == prefix).select("eid").orderBy("eid").limit(left).agg(F.max("eid")).first()[0]
    return marked.where((mark < prefix) | ((mark == prefix) & (F.col("eid") <= last))).drop("_hw_mark")


def permutation_split(edges: DataFrame, seed: int = 42) -> DataFrame:
    """First tenth by hash order: test; second: validation; the rest: training."""
    marked = with_ordinal(edges.withColumn("_hw_mark", hash_mod(F.col("eid"), seed, 1 << 39)), ["_hw_mark", "eid"], "place")
    n = marked.count()
    tenth = n // 10
    name = F.when(F.col("place") < tenth, "test").when(F.col("place") < 2 * tenth, "val").otherwise("train")
    return marked.withColumn("split", name).drop("_hw_mark", "place")


def batched(edges: DataFrame, batch_size: int, epoch: int = 0, seed: int = 42) -> DataFrame:
    """``(batch, eid, src, dst)``: edges of full batches in a hash order of the epoch."""
    order = hash_mod(F.col("eid"), seed + epoch, 1 << 39)
    placed = with_ordinal(edges.select("eid", "src", "dst", order.alias("mark")), ["mark", "eid"], "place")
    n = placed.count()
    return placed.withColumn("batch", F.floor(F.col("place") / batch_size)).where(F.col("batch") < n // batch_size).select("batch", "eid", "src", "dst")


def minibatches(edges: DataFrame, batch_size: int, epoch: int = 0, seed: int = 42) -> DataFrame:
    """Those edges with batch-local endpoint numbers.

    ``local_src`` and ``local_dst`` are places among the batch's sorted, distinct ends. Both
    ends are rows of one set, ranked within the batch and folded back where they are, so
    after the edges' placing there is one exchange, by batch.
    """
    sides = F.array(F.struct(F.lit(0).alias("end"), F.col("src").alias("id")), F.struct(F.lit(1).alias("end"), F.col("dst").alias("id")))
    ends = batched(edges, batch_size, epoch, seed).select("batch", "eid", "src", "dst", F.explode(sides).alias("x")).select("batch", "eid", "src", "dst", "x.*")
    numbered = ends.withColumn("local", F.dense_rank().over(Window.partitionBy("batch").orderBy("id")) - 1)
    local = lambda end: F.max(F.when(F.col("end") == end, F.col("local")))
    return numbered.groupBy("batch", "eid", "src", "dst").agg(local(0).alias("local_src"), local(1).alias("local_dst"))
