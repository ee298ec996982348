"""Exact nearest neighbours by cosine, with cells of vectors skipped by the triangle inequality.

Vectors are dealt to the nearest of a bounded number of centres and stored by cell, with
each cell's radius; a cell of many vectors is cut into blocks of bounded size. A query first
searches its own cell, which gives the score that any other neighbour has to reach; then it
goes only to cells that can hold one: for a centre at distance ``d`` and radius ``r`` no
vector is nearer than ``d - r``. So vectors move once to their blocks and once for each of
the two searches, and what grows with the queries are rows of (cell, query), at most one
for each centre. A task holds one block of vectors and streams the queries past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.operators.vectors import normalized
from hostweave.sources.scratch import cut

#: At most so many centres, and about so many vectors for each where there are fewer.
CENTRES, PER_CENTRE = 1024, 64
#: Vectors of a block, and rows of a batch that are compared with them, or with the centres, at once.
BLOCK, ROWS = 1 << 15, 256
#: Scores are compared to so many digits; a cell is skipped only if it misses by more than rounding can be.
DIGITS, SLACK = 6, 2e-6


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T), 0.0))


def cells(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``(id, v, cell, far)``: the nearest centre of each vector, and how far it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                some = batch.slice(i, ROWS)
                d = _distances(_matrix(some.column("v")), centres)
                at = d.argmin(axis=1)
                yield pa.record_batch([*some.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(at)), at])], ["id", "v", "cell", "far"])

    return vectors.mapInArrow(run, "id long, v array<float>, cell int, far double")


def _searched(held: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``(query_id, neighbor_id, cosine, compared)``: the best ``k`` of each block for each query sent to it.

    ``held(cell, block, id, v)`` and ``asked(cell, block, id, v)`` are sorted into one stream
    by block, vectors first. ``compared`` is, in a query's first row there, how many vectors it met.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        stack: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("cell", "block", "side")], axis=1)
            edges = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if i == j:
                    continue
                part, own = batch.slice(i, j - i), (int(key[i, 0]), int(key[i, 1]))
                if own != now:
                    now, ids, rows, stack = own, [], [], None
                if key[i, 2] == 0:
                    ids.append(part.column("id").to_numpy())
                    rows.append(_matrix(part.column("v")))
                    continue
                if not ids:
                    continue
                stack = stack or (np.concatenate(ids), np.concatenate(rows))
                for a in range(0, part.num_rows, ROWS):
                    yield best(part.slice(a, ROWS), *stack)

    def best(asking: pa.RecordBatch, ids: np.ndarray, held_rows: np.ndarray) -> pa.RecordBatch:
        near = np.round(_matrix(asking.column("v")) @ held_rows.T, DIGITS)
        out: list[tuple[np.ndarray, ...]] = []
        for q, row in zip(asking.column("id").to_pylist(), near, strict=True):
            use = np.flatnonzero(ids != q)
            met = len(use)
            if met > k:
                use = use[row[use] >= np.partition(row[use], -k)[-k]]  # with all ties of the last
            use = use[np.lexsort((ids[use], -row[use]))[:k]]
            if len(use):
                told = np.zeros(len(use), dtype=np.int64)
                told[0] = met
                out.append((np.full(len(use), q), ids[use], row[use], told))
        a, b, c, n = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64()), pa.array(n, pa.int64())], ["query_id", "neighbor_id", "cosine", "compared"])

    row = ["cell", "block", "side", "id", "v"]
    both = held.withColumn("side", F.lit(0)).select(*row).unionByName(asked.withColumn("side", F.lit(1)).select(*row))
    return both.repartition("cell", "block").sortWithinPartitions("cell", "block", "side").mapInArrow(run, "query_id long, neighbor_id long, cosine double, compared long")


def search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "id", centres: int = CENTRES, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(query_id, rank, neighbor_id, cosine)``, and one row of ``(queries, vectors, compared)``.

    ``compared`` counts the pairs of a query and another vector that were scored, of
    ``queries * (vectors - 1)``. Rows without a vector neither ask nor are found.
    """
    rows = lambda df: df.where(F.col("embedding").isNotNull()).select(F.col(id_col).cast("long").alias("id"), normalized(F.col("embedding")).alias("v"))
    held = rows(vectors)
    n = held.count()
    some = held.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(max(1, min(centres, n // PER_CENTRE))).collect()
    if not some:
        none = vectors.sparkSession.createDataFrame([], "query_id long, rank int, neighbor_id long, cosine double")
        return none, rows(queries).agg(F.count("*").alias("queries"), F.lit(0).cast("long").alias("vectors"), F.lit(0).cast("long").alias("compared"))
    middle = np.array([r["v"] for r in some], dtype=np.float64)
    stored = cut(cells(held, middle), "cells")
    sizes = {r["cell"]: (r["n"], r["far"]) for r in stored.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}  # at most the centres
    names = np.array(sorted(sizes), dtype=np.int32)
    parts = np.array([-(-sizes[c][0] // block) for c in names], dtype=np.int64)
    radius = np.array([sizes[c][1] for c in names]) + 1e-9
    centre = middle[names]
    count = F.create_map(*[F.lit(int(x)) for pair in zip(names, parts, strict=True) for x in pair if parts.max() > 1]) if parts.max() > 1 else None
    at = F.pmod(F.xxhash64("id"), count[F.col("cell")].cast("long")) if count is not None else F.lit(0).cast("long")
    blocks = stored.withColumn("block", at)
    asked = cut(cells(rows(queries), centre), "queries")  # here cells are places in ``names``

    def sent(batches: Iterator[pa.RecordBatch], own: bool) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            v = _matrix(batch.column("v"))
            mine = np.arange(len(centre)) == batch.column("cell").to_numpy()[:, None]
            if own:
                go = mine
            else:
                d = np.maximum(_distances(v, centre) - radius, 0.0)
                most = ((v * v).sum(axis=1)[:, None] + 1.0 - d * d) / 2 + SLACK
                go = ~mine & (most >= batch.column("least").to_numpy()[:, None])
            q, c = np.nonzero(go)
            times = parts[c]
            q, c = np.repeat(q, times), np.repeat(c, times)
            piece = np.arange(len(c)) - np.repeat(np.cumsum(times) - times, times)
            for i in range(0, len(q), 4096):
                yield pa.record_batch([pa.array(names[c[i : i + 4096]]), pa.array(piece[i : i + 4096]), *(batch.column(x).take(pa.array(q[i : i + 4096])) for x in ("id", "v"))], ["cell", "block", "id", "v"])

    fields = "cell int, block long, id long, v array<float>"
    first = cut(_searched(blocks, asked.mapInArrow(lambda b: sent(b, True), fields), k), "own-cell")
    reach = first.groupBy("query_id").agg(F.sort_array(F.collect_list("cosine"), False).alias("best")).select(F.col("query_id").alias("id"), F.try_element_at("best", F.lit(k)).alias("least"))
    rest = asked.join(reach, "id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    second = cut(_searched(blocks, rest.mapInArrow(lambda b: sent(b, False), fields), k), "other-cells")
    every = first.unionByName(second)
    order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "neighbor_id")
    found = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "cosine")
    told = every.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared")).select(F.lit(asked.count()).alias("queries"), F.lit(n).alias("vectors"), "compared")
    return found, told


def cosine_topk(vectors: DataFrame, queries: DataFrame | list[int], k: int, id_col: str = "id", **sizes: int) -> DataFrame:
    """``(query_id, rank, neighbor_id, cosine)``: the ``k`` nearest others of each query, ties by id.

    ``queries`` are rows with an id and an embedding, or a few ids of ``vectors``.
    """
    if isinstance(queries, list):
        queries = vectors.where(F.col(id_col).isin(queries))
    return search(vectors, queries, k, id_col, **sizes)[0]
