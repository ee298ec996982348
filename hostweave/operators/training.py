"""Shallow link-prediction embeddings by block training.

Ids fall into blocks by modulus; edges into buckets by the blocks of their two ends.
An epoch goes through rounds of disjoint buckets (each block occurs once in a round), and
a round is one Arrow job: a task gets a bucket's one or two blocks of vectors with Adam
moments, takes sparse steps over mini-batches of the bucket's edges as they stream by, and
returns the blocks. How many blocks there are follows from the numbers of nodes and edges,
unless it is configured: a bucket's vectors and edges are both bounded, so larger graphs keep
more tasks busy. Edges are written once, by round, and a round reads its own. State between rounds is a written table, so a lost executor costs one round
and a stopped run resumes at the last epoch.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.functions.hashing import hash_mod
from hostweave.operators.losses import initial_vectors
from hostweave.operators.vectors import eval_mrr
from hostweave.sources.scratch import remove


@dataclass(frozen=True)
class Config:
    dim: int = 128
    epochs: int = 3
    batch: int = 4096
    lr: float = 0.01
    schedule: str = "cosine"
    train_neg: int = 10
    neg_mode: str = "inbatch"
    eval_neg: int = 100
    blocks: int = 0
    seed: int = 42
    patience: int = 0
    max_edges: int = 0


def learning_rate(config: Config, epoch: int) -> float:
    """Cosine from ``lr`` at epoch 1 towards a hundredth of it, or constant."""
    low = config.lr / 100
    if config.schedule != "cosine":
        return config.lr
    return low + (config.lr - low) * (1 + math.cos(math.pi * (epoch - 1) / config.epochs)) / 2


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def inbatch_loss(pos: np.ndarray, neg: np.ndarray) -> float:
    """Mean binary cross-entropy of positives plus that of negatives."""
    return float(softplus(-pos).mean() + softplus(neg).mean())


def binary_loss(scores: np.ndarray, labels: np.ndarray) -> float:
    return float((softplus(scores) - labels * scores).mean())


STATE = "id long, embedding array<float>, m array<float>, v array<float>"
#: Bytes of a vector's entry with both moments, and of the vectors that a task holds at most.
ENTRY_BYTES, TASK_BYTES = 12, 512 << 20
#: Bits of a row's place within its bucket's vectors or edges: an id, or an edge's hash.
PLACE_BITS = 47
#: Edges of a bucket, which one task takes after the other, on average at most.
BUCKET_EDGES = 1 << 21


def block_count(num_nodes: int, config: Config, edges: int = 0) -> int:
    """The configured number of blocks, or else as many as keep two of them within a task's bytes, and a bucket's edges within their bound."""
    return config.blocks or max(1, -(-2 * num_nodes * config.dim * ENTRY_BYTES // TASK_BYTES), math.ceil(math.sqrt(2 * edges / BUCKET_EDGES)) if edges > BUCKET_EDGES else 1)


def initial(spark: SparkSession, num_nodes: int, config: Config) -> DataFrame:
    """``(id, embedding, m, v)``: the starting vectors, moments at zero."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), config.dim)
    return initial_vectors(spark, num_nodes, config.dim, config.seed).select("id", "embedding", zero.alias("m"), zero.alias("v"))


def rounds(blocks: int) -> list[list[tuple[int, int]]]:
    """Unordered block pairs in as many rounds as blocks: those of one sum modulo that number, so a block has one partner in each."""
    return [[(a, (k - a) % blocks) for a in range(blocks) if a <= (k - a) % blocks] for k in range(blocks)]


def summed(index: np.ndarray, rows: np.ndarray, size: int, room: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows of each index from 0 to ``size`` - 1, each of which occurs; ``room`` is overwritten."""
    order = np.argsort(index.astype(np.uint16 if size <= 1 << 16 else np.int64), kind="stable")
    turned = np.take(rows, order, axis=0, out=room, mode="clip")
    return np.add.reduceat(turned, np.searchsorted(index[order], np.arange(size)), axis=0)


class Block:
    """The vectors of one bucket's blocks with Adam's moments, and the steps taken on them."""

    def __init__(self, ids: np.ndarray, table: np.ndarray, m: np.ndarray, v: np.ndarray, step: int, lr: float, config: Config, seed: int) -> None:
        self.ids, self.table, self.m, self.v, self.step, self.lr, self.config = ids, table, m, v, step, lr, config
        self.rng, self.loss, self.seen = np.random.default_rng(seed), 0.0, 0
        # every step's large arrays, allocated once
        k, dim = config.train_neg, table.shape[1]
        self.far, self.rows, self.room = (np.empty(s, table.dtype) for s in ((config.batch, k, dim), (config.batch * (k + 2), dim), (config.batch * (k + 2), dim)))

    def take(self, src: np.ndarray, dst: np.ndarray) -> None:
        """One sparse step over a mini-batch of edges."""
        config, n = self.config, len(src)
        ends, local = np.unique(np.searchsorted(self.ids, np.concatenate([src, dst])), return_inverse=True)
        pool = len(ends) if config.neg_mode == "inbatch" else len(self.table)
        drawn = self.rng.integers(0, pool, (n, config.train_neg))
        a, b = local[:n], local[n:]
        if config.neg_mode != "inbatch":  # uniform over the task's nodes
            ends, back = np.unique(np.concatenate([ends, drawn.ravel()]), return_inverse=True)
            a, b, drawn = back[a], back[b], back[len(back) - drawn.size :].reshape(drawn.shape)
        x = self.table[ends]
        far = np.take(x, drawn, axis=0, out=self.far[:n], mode="clip")
        pos, neg = np.einsum("ij,ij->i", x[a], x[b]), np.einsum("ij,ikj->ik", x[a], far)
        self.loss, self.seen, self.step = self.loss + inbatch_loss(pos, neg) * n, self.seen + n, self.step + 1
        gp = -1 / (1 + np.exp(np.clip(pos, -30, 30))) / n
        gn = 1 / (1 + np.exp(-np.clip(neg, -30, 30))) / neg.size
        rows = self.rows[: n * (config.train_neg + 2)]
        rows[:n], rows[n : 2 * n] = gp[:, None] * x[b] + np.einsum("ik,ikj->ij", gn, far), gp[:, None] * x[a]
        np.multiply(gn[..., None], x[a][:, None], out=rows[2 * n :].reshape(far.shape), casting="same_kind")
        grad = summed(np.concatenate([a, b, drawn.ravel()]), rows, len(x), self.room[: len(rows)])
        self.m[ends] = 0.9 * self.m[ends] + 0.1 * grad
        self.v[ends] = 0.999 * self.v[ends] + 0.001 * grad**2
        self.table[ends] -= self.lr * (self.m[ends] / (1 - 0.9**self.step)) / (np.sqrt(self.v[ends] / (1 - 0.999**self.step)) + 1e-8)


def _round(edges: DataFrame, state: DataFrame, pairs: list[tuple[int, int]], blocks: int, config: Config, lr: float, seed: int, step: int) -> DataFrame:
    """The vectors of the given buckets' blocks after training on the buckets' edges.

    A bucket's vectors come first in one sorted stream, and its edges, in a hashed order,
    are taken batch by batch as they come; so a task holds two blocks of bounded size and
    never a bucket's edges, however many a hub has.
    """
    bucket_of = {b: i for i, pair in enumerate(pairs) for b in pair}
    named = F.create_map(*[F.lit(x) for kv in bucket_of.items() for x in kv])
    low, high = F.least(F.col("src") % blocks, F.col("dst") % blocks).cast("int"), F.greatest(F.col("src") % blocks, F.col("dst") % blocks).cast("int")
    there = F.try_element_at(named, low)
    chosen = (there == F.try_element_at(named, high)) & (F.element_at(F.array(*[F.lit(a != b) for a, b in pairs]), there + 1) == (low != high))
    # empty, not null: of null lists, Arrow's writer fills all places again for each row that it sizes up
    none, order = F.array().cast("array<float>"), F.xxhash64(F.lit(seed), "src", "dst", "eid").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    use = edges.where(chosen).select(there.alias("bucket"), F.lit(1).alias("side"), order.alias("mark"), F.col("src").alias("id"), "dst", none.alias("embedding"), none.alias("m"), none.alias("v"))
    held = state.select(F.try_element_at(named, (F.col("id") % blocks).cast("int")).alias("bucket"), F.lit(0).alias("side"), F.col("id").alias("mark"), "id", F.lit(0).cast("long").alias("dst"), "embedding", "m", "v").where("bucket IS NOT NULL")
    kind = pa.list_(pa.float32())

    def out(block: Block) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(block.ids), 8192):
            n = len(block.ids[i : i + 8192])
            told = lambda x: pa.array(np.where(np.arange(n) == 0, x if i == 0 else 0, 0))  # noqa: B023, E731
            rows = [pa.array(list(x[i : i + 8192]), kind) for x in (block.table, block.m, block.v)]
            yield pa.record_batch([pa.array(block.ids[i : i + 8192]), *rows, told(float(block.loss)).cast(pa.float64()), told(block.seen).cast(pa.int64()), pa.array(np.full(n, block.step, dtype=np.int64))], ["id", "embedding", "m", "v", "loss", "n", "step"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def whole() -> Block:
            ids = np.concatenate([p.column("id").to_numpy() for p in parts])
            stack = lambda c: np.concatenate([p.column(c).flatten().to_numpy() for p in parts]).reshape(len(ids), -1).astype(np.float32)
            return Block(ids, stack("embedding"), stack("m"), stack("v"), step, lr, config, seed + int(now))

        def steps(least: int) -> None:
            src, dst = (np.concatenate(x) for x in zip(*waiting, strict=True))
            at = 0
            while len(src) - at >= least and at < len(src):
                block.take(src[at : at + config.batch], dst[at : at + config.batch])
                at += config.batch
            waiting[:] = [(src[at:], dst[at:])] if at < len(src) else []

        def ended() -> Iterator[pa.RecordBatch]:
            if now is not None and (block is not None or parts):
                if waiting:
                    steps(1)
                yield from out(block if block is not None else whole())

        for batch in batches:
            key = np.stack([batch.column("bucket").to_numpy(), batch.column("side").to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                some = batch.slice(i, j - i)
                if key[i, 0] != now:
                    yield from ended()
                    now, parts, block, waiting = int(key[i, 0]), [], None, []
                if key[i, 1] == 0:
                    parts.append(some)
                else:
                    block = block or whole()
                    parts = []
                    waiting.append((some.column("id").to_numpy(), some.column("dst").to_numpy()))
                    if sum(len(x) for x, _ in waiting) >= config.batch:
                        steps(config.batch)
        yield from ended()

    rows = held.unionByName(use)
    turn = ((F.col("bucket") * 2 + F.col("side")).cast("long") * (1 << PLACE_BITS) + F.col("mark")).alias("turn")  # one number, which Spark sorts by its digits
    dealt = rows.repartitionById(len(pairs), F.col("bucket")).select("*", turn).sortWithinPartitions("turn")
    return dealt.mapInArrow(run, STATE + ", loss double, n long, step long")


def train_embeddings(edges: DataFrame, num_nodes: int, config: Config, folder: str, validation: DataFrame | None = None, stop: Callable[[], bool] | None = None) -> tuple[DataFrame, list[dict]]:
    """Trains, keeps the best epoch by validation MRR, and returns it with the history.

    ``folder`` is a shared place; each epoch's table is written there before the pointer
    file names it, and a call with the same folder goes on after the last one named. Rounds'
    tables, each of the blocks that it trained, go once nothing reads them.
    """
    spark = edges.sparkSession
    used = edges if config.max_edges <= 0 else edges.where(F.col("eid") < config.max_edges)
    blocks = block_count(num_nodes, config, used.count())
    meets = (F.pmod("src", F.lit(blocks)) + F.pmod("dst", F.lit(blocks))) % blocks
    used.select("eid", "src", "dst", meets.cast("int").alias("round")).write.mode("overwrite").partitionBy("round").parquet(f"{folder}/edges")
    used = spark.read.schema("eid long, src long, dst long, round int").parquet(f"{folder}/edges")
    history = read_pointer(spark, folder)
    if history and history[-1]["config"] != asdict(config):
        raise ValueError("the folder holds a run of another configuration")
    if history:
        state = spark.read.schema(STATE).parquet(f"{folder}/epoch-{len(history)}")
    else:
        initial(spark, num_nodes, config).write.mode("overwrite").parquet(f"{folder}/epoch-0")
        state = spark.read.schema(STATE).parquet(f"{folder}/epoch-0")
    latest = dict.fromkeys(range(blocks), f"{folder}/epoch-{len(history)}")

    def stored(where: dict[int, str]) -> DataFrame:
        """Each block from the last table that a round wrote it to; a round writes its own blocks only."""
        by_path: dict[str, list[int]] = {}
        for block, path in where.items():
            by_path.setdefault(path, []).append(block)
        return reduce(DataFrame.unionByName, [spark.read.schema(STATE).parquet(path).where((F.col("id") % blocks).isin(own)) for path, own in by_path.items()])

    for epoch in range(len(history) + 1, config.epochs + 1):
        lr, loss, seen = learning_rate(config, epoch), 0.0, 0
        step = history[-1]["step"] if history else 0
        written: dict[str, None] = {}
        for k, pairs in enumerate(rounds(blocks)):
            path = f"{folder}/epoch-{epoch}-round-{k}"
            _round(used.where(F.col("round") == k), state, pairs, blocks, config, lr, config.seed + 1000 * epoch + k, step).write.mode("overwrite").parquet(path)
            done = spark.read.schema(STATE + ", loss double, n long, step long").parquet(path)
            got = done.agg(F.sum("loss"), F.sum("n"), F.max("step")).first()
            step = max(step, got[2] or 0)  # Adam's bias correction goes on from the steps that were taken
            loss, seen = loss + (got[0] or 0.0), seen + (got[1] or 0)
            latest |= {b: path for pair in pairs for b in pair}
            written[path] = None
            state = stored(latest)
            for old in [p for p in written if p not in latest.values()]:
                remove(spark, old)
                del written[old]
        state.write.mode("overwrite").parquet(f"{folder}/epoch-{epoch}")
        state, latest = spark.read.schema(STATE).parquet(f"{folder}/epoch-{epoch}"), dict.fromkeys(range(blocks), f"{folder}/epoch-{epoch}")
        for old in written:
            remove(spark, old)
        entry = {"epoch": epoch, "lr": lr, "loss": loss / max(seen, 1), "step": step, "config": asdict(config)}
        if validation is not None:
            entry |= eval_mrr(validation, state.select("id", "embedding"), num_nodes, config.eval_neg, config.seed + epoch).first().asDict()
        history.append(entry)
        write_pointer(spark, folder, history)
        best = max(history, key=lambda h: h.get("mrr", h["epoch"]))
        if stop and stop() or config.patience and epoch - best["epoch"] >= config.patience:
            break
    best = max(history, key=lambda h: (h.get("mrr", h["epoch"]), -h["epoch"] if "mrr" in h else 0))
    return spark.read.parquet(f"{folder}/epoch-{best['epoch']}").select("id", "embedding"), history


def write_pointer(spark: SparkSession, folder: str, history: list[dict]) -> None:
    spark.createDataFrame([(i, json.dumps(h)) for i, h in enumerate(history)], "i int, entry string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/history")


def read_pointer(spark: SparkSession, folder: str) -> list[dict]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/history/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    return [json.loads(r["entry"]) for r in spark.read.parquet(f"{folder}/history").orderBy("i").collect()]


def uniform_negatives(edges: DataFrame, num_nodes: int, k: int, seed: int = 42) -> DataFrame:
    """``(eid, k, neg_id)``: hashed uniform draws with replacement."""
    return edges.select("eid", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k")).withColumn("neg_id", hash_mod(F.col("eid") * k + F.col("k"), seed, num_nodes))
