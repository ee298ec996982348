"""Best-fit packing of documents into sequences under conflict constraints.

A sequence (bin) holds ``capacity`` characters. No bin holds two documents of one
duplicate cluster (equal texts, or what ``cluster_col`` says), nor more than ``per_source`` documents of one source.
Documents longer than a bin are cut into full bins and a rest. Bins are kept in order of
what they have left, each with a bitmap of the duplicate clusters it holds and, for each
count up to the limit, a bitmap of the sources it holds that often. A document goes to
the bin with the least room that suffices; where that one conflicts, the search moves on
to the next tighter fit until one is compatible, or opens a bin. Bins that are alike are
looked at once, and ranges of rooms where all bins conflict are passed over, so that
thousands of equal texts, or of one source, cost no scan of all bins each.

The corpus is dealt into groups of about ``group_bins`` bins by a hash of the rows; each
group packs by itself, largest document first, so no task depends on the corpus' size,
and equal texts, however many, spread over all groups. Only lengths, sources and hashes
of texts are moved.

Defined results: null text is the empty text; empty texts take no room, but are equal to
each other, so each lies in another bin; a null source is no source and never conflicts,
and a null cluster none either; a very long text fills as many bins as it needs; ties are broken by hash, then id; repeated rows are packed
one by one; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from functools import reduce
from heapq import heappop, heappush
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import documents


class Bins:
    """Open bins in order of room left, with conflict bitmaps.

    Bins of equal room and equal conflicts are alike, so an entry stands for all of them
    and names the first. Entries lie in leaves by room. A tree over the leaves holds, for
    each range of rooms, what all its bins hold: a range where that alone conflicts is
    passed over at once. Intersections may lag behind (hold too little) after a bin
    leaves; they are renewed when a search has looked through a leaf in vain.
    """

    LEAVES = 1 << 16

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.grain = capacity // self.LEAVES + 1
        self.width = 1 << (capacity // self.grain).bit_length()
        self.leaves: dict[int, list[tuple[int, int, tuple[int, int]]]] = {}  # (room, first bin, conflicts)
        self.alike: dict[tuple[int, tuple[int, int]], list[int]] = {}  # heap of bins
        self.held = [[-1] * (2 * self.width) for _ in range(2)]  # in all bins of a range: clusters, full sources
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # by bin: bitmap of sources held at least 1, 2, ... times

    def _renew(self, leaf: int, values: tuple[int, int]) -> None:
        for held, value in zip(self.held, values, strict=True):
            node = leaf + self.width
            while node and held[node] != value:
                held[node] = value
                node >>= 1
                value = held[2 * node] & held[2 * node + 1] if node else 0

    def _put(self, room: int, b: int) -> None:
        conflicts = self.clusters[b], self.sources[b][-1]
        leaf = room // self.grain
        entries = self.leaves.setdefault(leaf, [])
        bins = self.alike.setdefault((room, conflicts), [])
        if bins and b < bins[0]:
            del entries[bisect_left(entries, (room, bins[0]))]
        if not bins or b < bins[0]:
            insort(entries, (room, b, conflicts))
        heappush(bins, b)
        self._renew(leaf, tuple(held[leaf + self.width] & own for held, own in zip(self.held, conflicts, strict=True)))

    def _take(self, leaf: int, at: int) -> tuple[int, int]:
        entries = self.leaves[leaf]
        room, b, conflicts = entries.pop(at)
        bins = self.alike[room, conflicts]
        heappop(bins)
        if bins:
            insort(entries, (room, bins[0], conflicts))
        else:
            del self.alike[room, conflicts]
        if not entries:
            self._renew(leaf, (-1, -1))
        return room, b

    def _next_leaf(self, leaf: int, cluster_bit: int, source_bit: int) -> int | None:
        """The first leaf from this one on whose bins don't all conflict, by their intersections."""
        node = leaf + self.width
        while node:
            if self.held[0][node] & cluster_bit or self.held[1][node] & source_bit:
                while node & 1:
                    node >>= 1
                node += node > 0
            elif node >= self.width:
                return node - self.width
            else:
                node *= 2
        return None

    def _tightest(self, size: int, cluster_bit: int, source_bit: int) -> tuple[int, int] | None:
        leaf = self._next_leaf(size // self.grain, cluster_bit, source_bit)
        while leaf is not None:
            entries = self.leaves[leaf]
            for at in range(bisect_left(entries, (size, -1)), len(entries)):
                clusters, full = entries[at][2]
                if not (clusters & cluster_bit or full & source_bit):
                    return leaf, at
            self._renew(leaf, (reduce(and_, (e[2][0] for e in entries)), reduce(and_, (e[2][1] for e in entries))))
            leaf = self._next_leaf(leaf + 1, cluster_bit, source_bit) if leaf + 1 < self.width else None
        return None

    def place(self, size: int, source: int | None, cluster: int | None) -> tuple[int, int]:
        """The bin that takes the document, and the document's offset there."""
        source_bit = 0 if source is None else 1 << source
        cluster_bit = 0 if cluster is None else 2 << cluster
        found = self._tightest(size, cluster_bit | 1, source_bit)  # bit 0 is set in ranges without a bin only
        if found:
            room, b = self._take(*found)
        else:
            room, b = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
        self.clusters[b] |= cluster_bit
        for k, held in enumerate(self.sources[b]):
            if not held & source_bit:
                self.sources[b][k] |= source_bit
                break
        self._put(room - size, b)
        return b, self.capacity - room


def pack_group(sizes: list[int], sources: list[str | None], clusters: list[int | None], capacity: int, per_source: int) -> list[list[tuple[int, int, int, int]]]:
    """For each document its ``(bin, offset, start, length)`` pieces; documents come largest first."""
    number: dict[str, int] = {}
    seen: dict[int, int] = {}
    for c in filter(lambda c: c is not None, clusters):
        seen[c] = seen.get(c, 0) + 1
    shared = {c: i for i, c in enumerate(sorted((c for c, n in seen.items() if n > 1), key=lambda c: -seen[c]))}  # common ones first: short bitmaps
    bins = Bins(capacity, per_source)
    out: list[list[tuple[int, int, int, int]]] = []
    rests = []
    for i, size in enumerate(sizes):
        full = (size - 1) // capacity if size else 0
        out.append([(0, 0, k * capacity, capacity) for k in range(full)])
        rests.append((size - full * capacity, i))
    rests.sort(key=lambda x: -x[0])  # stable: rests of equal size stay in the given order
    for rest, i in rests:
        source = None if sources[i] is None else number.setdefault(sources[i], len(number))
        b, offset = bins.place(rest, source, shared.get(clusters[i]))
        out[i].append((b, offset, sizes[i] - rest, rest))
    n = len(bins.clusters)
    for pieces in out:
        for k in range(len(pieces) - 1):
            pieces[k] = (n, 0, *pieces[k][2:])
            n += 1
    return out


def packed(docs: DataFrame, capacity: int = 32768, per_source: int = 4, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", group_bins: int = 1024, cluster_col: str | None = None) -> DataFrame:
    """``(doc_id, part, start, length, bin, offset)``: where each piece of each document lies.

    ``start`` and ``length`` are in characters of the text, ``offset`` in those of the bin.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.xxhash64(text, F.length(text))
    cluster = same if cluster_col is None else F.when(F.col(cluster_col).isNotNull(), F.xxhash64(cluster_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.length(text).cast("long").alias("n"), cluster.alias("cluster"), same.alias("same"))
    total, count = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    groups = max(1, round(total / (capacity * group_bins)), count // (64 * group_bins))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "same", F.lit("group")), F.lit(groups))).withColumn("mark", F.xxhash64("doc_id", "same", F.lit("order"))).drop("same")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "descending"), ("mark", "ascending"), ("doc_id", "ascending")])
        group = table.column("group")[0].as_py()
        ids = table.column("doc_id").to_pylist()
        found = pack_group(table.column("n").to_pylist(), table.column("source").to_pylist(), table.column("cluster").to_pylist(), capacity, per_source)
        flat = [(ids[i], k, start, length, group << 32 | b, offset) for i, pieces in enumerate(found) for k, (b, offset, start, length) in enumerate(pieces)]
        return pa.table({n: pa.array([f[k] for f in flat], pa.int64()) for k, n in enumerate(("doc_id", "part", "start", "length", "bin", "offset"))})

    return rows.groupBy("group").applyInArrow(run, "doc_id long, part long, start long, length long, bin long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
