"""The directed graph as two DataFrames, and the operators over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.operators import packed
from hostweave.operators.ordinals import with_ordinal
from hostweave.sources.scratch import cut

#: The retention ladder's thresholds and the histogram's bin edges.
THRESHOLDS = (1, 2, 3, 4, 8, 16, 32, 64, 128, 256, 512, 1024)
BIN_EDGES = (0, 1, 2, 3, 5, 9, 17, 33, 65, 129, 257, 513, 1025, 1 << 62)


@dataclass(frozen=True)
class HostGraph:
    """``edges(eid, src, dst)`` in ordinal order, ids ``0 .. num_nodes - 1``.

    ``nodes(id, name, ...)`` is optional and may carry further columns (features), which
    every operator that keeps the node set hands on. Duplicate edges and self-loops count.
    ``by_dst`` is optional too: the same edges stored by target, where ``edges`` are stored by
    source, so that what is counted by node is counted where it lies. ``about`` is a bound of
    the number of edges by which work is dealt out; where there is none, they are counted.
    """

    edges: DataFrame
    num_nodes: int
    nodes: DataFrame | None = None
    by_dst: DataFrame | None = None
    about: int | None = None

    @classmethod
    def from_edges(cls, edges: DataFrame, num_nodes: int | None = None, nodes: DataFrame | None = None) -> HostGraph:
        """Checks the columns and the id range; infers the node count as largest id + 1."""
        missing = {"src", "dst"} - set(edges.columns)
        if missing:
            raise ValueError(f"edges need columns src and dst; missing: {sorted(missing)}")
        if "eid" not in edges.columns:
            edges = with_ordinal(edges, ["src", "dst"], "eid")
        low, high = edges.agg(F.min(F.least("src", "dst")), F.max(F.greatest("src", "dst"))).first()
        n = (-1 if high is None else high) + 1 if num_nodes is None else num_nodes
        if low is not None and (low < 0 or high >= n):
            raise ValueError(f"edge ids must lie in [0, {n}); found {low} to {high}")
        return cls(edges, n, nodes)

    def ids(self) -> DataFrame:
        return self.edges.sparkSession.range(self.num_nodes)

    def num_edges(self) -> int:
        return self.edges.count()

    def degrees(self) -> DataFrame:
        return degrees(self.edges, self.ids()) if self.by_dst is None else stored_degrees(self.edges, self.by_dst, self.ids())

    def out_neighbors(self, node: int) -> DataFrame:
        return self.edges.where(F.col("src") == node).select("eid", F.col("dst").alias("neighbor")).orderBy("eid")

    def in_neighbors(self, node: int) -> DataFrame:
        return self.edges.where(F.col("dst") == node).select("eid", F.col("src").alias("neighbor")).orderBy("eid")

    def adjacency_offsets(self, outgoing: bool = True) -> DataFrame:
        """``(id, offset, n)`` of every node: where its neighbours begin in the array of all, and how many there are."""
        counts = self.edges.groupBy(F.col("src" if outgoing else "dst").alias("id")).agg(F.count("*").alias("n"))
        full = cut(self.ids().join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n")), "list-sizes")
        return offsets(full).join(full, "id").select("id", "offset", "n")

    def adjacency_chunks(self, outgoing: bool = True, bound: int = 1 << 16) -> DataFrame:
        """``(id, cell, offset, neighbors)``: the neighbours in edge order, in rows of at most ``bound``.

        The array of all neighbours, in order of node and edge, is cut into cells of
        ``bound`` places, and a node's list where it crosses into the next cell. A hub is
        many rows, which any tasks gather; ``offset`` is where a row begins in that array.
        """
        a, b = ("src", "dst") if outgoing else ("dst", "src")
        placed = with_ordinal(self.edges.select(F.col(a).alias("id"), F.col(b).alias("n"), "eid"), ["id", "eid"], "place")
        inside = F.array_sort(F.collect_list(F.struct("place", "n")))
        rows = placed.groupBy("id", F.expr(f"place div {int(bound)}").alias("cell")).agg(F.min("place").alias("offset"), inside.alias("x"))
        return rows.select("id", "cell", "offset", F.transform("x", lambda x: x["n"]).alias("neighbors"))

    def adjacency(self, outgoing: bool = True) -> DataFrame:
        """``(id, offset, neighbors)``: whole lists in edge order, for graphs without hubs too large for a row."""
        a, b = ("src", "dst") if outgoing else ("dst", "src")
        lists = self.edges.groupBy(F.col(a).alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("eid", F.col(b).alias("n")))), lambda x: x["n"]).alias("neighbors"))
        none = F.array().cast("array<bigint>")
        return self.adjacency_offsets(outgoing).join(lists, "id", "left").select("id", "offset", F.coalesce("neighbors", none).alias("neighbors"))

    def to_undirected(self) -> HostGraph:
        """Edges in both directions, each once; nodes and their columns stay."""
        pairs = self.edges.select("src", "dst").unionByName(self.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        rows = 2 * (self.num_edges() if self.about is None else self.about)
        return HostGraph(with_ordinal(pairs, ["src", "dst"], "eid", rows=rows, distinct=True), self.num_nodes, self.nodes)

    def where_edges(self, keep: Column) -> HostGraph:
        """The kept edges over the same nodes."""
        return HostGraph(self.edges.where(keep), self.num_nodes, self.nodes)

    def prefix(self, n: int) -> HostGraph:
        """The first ``n`` edges by ordinal (0: all)."""
        return self if n <= 0 else self.where_edges(F.col("eid") < n)

    def compacted(self) -> tuple[HostGraph, DataFrame]:
        """Only nodes that occur in edges, renumbered in order; also ``(orig_id, compact_id)``."""
        ids = with_ordinal(endpoints(self.edges), ["id"], "compact_id", rows=self.num_nodes).select(F.col("id").alias("orig_id"), "compact_id")
        return HostGraph(rekeyed(self.edges, ids), ids.count(), _named(self.nodes, ids)), ids


def offsets(counts: DataFrame) -> DataFrame:
    """``(id, offset)``: running sums of ``n`` in order of ``id``, range by range."""
    spark = counts.sparkSession
    size = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    high = counts.agg(F.max("id")).first()[0] or 0
    width = high // size + 1
    ranged = counts.withColumn("part", F.floor(F.col("id") / width))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranged.groupBy("part").agg(F.sum("n").alias("s")).select("part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("run", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, "part").select("id", (F.col("start") + F.col("run")).alias("offset"))


def endpoints(edges: DataFrame) -> DataFrame:
    """Distinct ids that occur in edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degrees(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, in_degree, out_degree, degree)`` for every id; a self-loop counts in both.

    One pass and one shuffle of partial counts: each edge yields its two ends.
    """
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("o")))).alias("e")).select("e.id", "e.o")
    counts = ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.count("*").alias("degree"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    out = ids.join(counts, "id", "left").select("id", zero("out_degree").alias("out_degree"), zero("degree").alias("degree"))
    return out.select("id", (F.col("degree") - F.col("out_degree")).alias("in_degree"), "out_degree", "degree")


def stored_degrees(by_src: DataFrame, by_dst: DataFrame, ids: DataFrame) -> DataFrame:
    """The same from edges stored by either end: each is counted in its bucket, and only ids are exchanged."""
    out = by_src.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))
    into = by_dst.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    both = ids.join(out, "id", "left").join(into, "id", "left").select("id", zero("in_degree").alias("in_degree"), zero("out_degree").alias("out_degree"))
    return both.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def totals(degree: DataFrame) -> DataFrame:
    """One row: nodes, edges, dangling nodes (isolated ones included), mean degree."""
    dangling = F.sum((F.col("out_degree") == 0).cast("long"))
    return degree.agg(
        F.count("*").alias("num_nodes"),
        F.sum("out_degree").alias("total_edges"),
        dangling.alias("n_dangling"),
        F.round(dangling / F.count("*"), 5).alias("frac_dangling"),
        F.round(F.sum("degree") / F.count("*"), 4).alias("mean_degree"),
    )


def edge_min_degree(edges: DataFrame, degree: DataFrame) -> DataFrame:
    """``(low)``: the lesser degree of each edge's ends."""
    d = degree.select("id", "degree")
    a = d.select(F.col("id").alias("src"), F.col("degree").alias("ds"))
    b = d.select(F.col("id").alias("dst"), F.col("degree").alias("dd"))
    return edges.join(a, "src").join(b, "dst").select(F.least("ds", "dd").alias("low"))


def edge_classes(edges: DataFrame, degree: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """``(at)`` for each edge: how many of the ascending thresholds its ends' lesser degree reaches.

    Degrees go to the edges as packed classes, whole while they fit and else by blocks; more
    thresholds than a class has room for take two joins with the degrees.
    """
    reached = lambda d: F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda t: t <= d))
    if len(thresholds) > 15:
        return edge_min_degree(edges, degree).select(reached(F.col("low")).alias("at"))
    nodes = (degree.agg(F.max("id")).first()[0] or 0) + 1
    classes = packed.packed_classes(degree.select("id", reached(F.col("degree")).alias("at")))
    if packed.fits(nodes, packed.CLASS_BITS):
        return packed.lesser_class(edges, classes)
    return packed.gridded_class(edges, cut(classes, "classes"), nodes)


def induced_edge_counts(edges: DataFrame, degree: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """``(min_degree, induced_edges)`` by classes and a suffix sum over them."""
    counts = edge_classes(edges, degree, thresholds).groupBy("at").agg(F.count("*").alias("n"))
    steps = edges.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(thresholds)], "at int, min_degree int")
    suffix = Window.orderBy(F.desc("at"))  # one row per threshold
    return steps.join(counts, "at", "left").select("min_degree", F.sum(F.coalesce("n", F.lit(0))).over(suffix).alias("induced_edges"))


def retention_ladder(degree: DataFrame, edges: DataFrame | None = None, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """What is left at each minimum degree; with ``edges`` also of the edges.

    All thresholds are conditional sums of one aggregation, a row that is then unfolded.
    With ``edges``, the degrees are written once, as several steps read them.
    """
    if edges is not None:
        degree = cut(degree.select("id", "degree"), "degrees")
    kept = [F.sum((F.col("degree") >= t).cast("long")).alias(f"n{t}") for t in thresholds]
    ends = [F.sum(F.when(F.col("degree") >= t, F.col("degree")).otherwise(0)).alias(f"e{t}") for t in thresholds]
    one = degree.agg(F.count("*").alias("n"), F.sum("degree").alias("all"), *kept, *ends)
    cells = [F.struct(F.lit(t).alias("t"), *[F.coalesce(F.col(f"{p}{t}"), F.lit(0)).alias(c) for c, p in (("k", "n"), ("e", "e"))]) for t in thresholds]
    flat = one.select("n", "all", F.explode(F.array(*cells)).alias("r")).select("n", "all", "r.*")
    frac = F.col("k") / F.greatest(F.col("n"), F.lit(1))
    out = [
        F.col("t").alias("min_degree"),
        F.col("k").alias("n_nodes"),
        F.round(frac, 5).alias("frac_nodes"),
        F.round(1 - frac, 5).alias("frac_fallback"),
        F.round(F.col("e") / F.greatest(F.col("all"), F.lit(1)), 5).alias("endpoint_incidence"),
    ]
    if edges is not None:
        flat = flat.join(induced_edge_counts(edges, degree, thresholds).withColumnRenamed("min_degree", "t"), "t")  # a row for each threshold
        half = F.coalesce(F.col("all"), F.lit(0)) / 2  # an edge is two ends
        out += ["induced_edges", F.round(F.col("induced_edges") / F.greatest(half, F.lit(1)), 5).alias("frac_edges")]
    return flat.select(*out)


def degree_histogram(degree: DataFrame, edges: tuple[int, ...] = BIN_EDGES) -> DataFrame:
    """``(deg_lo, deg_hi, n_nodes)`` of right-open bins, empty ones included."""
    lower = F.array(*[F.lit(e).cast("long") for e in edges[:-1]])
    at = F.array_max(F.filter(lower, lambda e: e <= F.col("degree")))
    counts = degree.groupBy(at.alias("deg_lo")).agg(F.count("*").alias("n"))
    bins = degree.sparkSession.createDataFrame([(a, b - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)], "deg_lo long, deg_hi long")
    return bins.join(counts, "deg_lo", "left").select("deg_lo", "deg_hi", F.coalesce("n", F.lit(0)).alias("n_nodes"))


def keep_map(degree: DataFrame, min_degree: int) -> DataFrame:
    """``(orig_id, compact_id)`` of nodes of at least that degree in the full graph, in order of id."""
    if min_degree < 1:
        raise ValueError("min_degree must be at least 1")
    kept = cut(degree.where(F.col("degree") >= min_degree).select(F.col("id").alias("orig_id")), "kept")
    return with_ordinal(kept, ["orig_id"], "compact_id").select("orig_id", "compact_id")


def rekeyed(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with both ends in ``ids``, under their compact ids; ``eid`` keeps the order.

    Two equi-joins that filter and rename at once. The optimiser broadcasts the map only
    while its size is below the session's threshold, and else merges.
    """
    a = ids.select(F.col("orig_id").alias("src"), F.col("compact_id").alias("a"))
    b = ids.select(F.col("orig_id").alias("dst"), F.col("compact_id").alias("b"))
    return edges.join(a, "src").join(b, "dst").select("eid", F.col("a").alias("src"), F.col("b").alias("dst"))


def _named(nodes: DataFrame | None, ids: DataFrame) -> DataFrame | None:
    if nodes is None:
        return None
    return nodes.join(ids, nodes.id == ids.orig_id).select(F.col("compact_id").alias("id"), *[c for c in nodes.columns if c != "id"], "orig_id")


def min_degree_slice(graph: HostGraph, min_degree: int, degree: DataFrame | None = None) -> tuple[HostGraph, DataFrame]:
    """The subgraph induced by nodes of at least that total degree, and the id map.

    The degree is that of the full graph, so a kept node may have fewer edges left. The kept
    set goes to the edges as bits with ranks while it fits: then no edge is exchanged, and
    none is joined that isn't kept. Else the edges meet the id map by two joins.
    """
    if min_degree < 1:
        raise ValueError("min_degree must be at least 1")
    degree = graph.degrees() if degree is None else degree
    small = packed.fits(graph.num_nodes, packed.SET_BITS)
    if small:
        kept = cut(degree.where(F.col("degree") >= min_degree).select(F.col("id").alias("orig_id")), "kept")
        bits = cut(packed.packed_set(kept, "orig_id"), "kept-bits")
        side = F.broadcast(bits)
        ids = kept.join(side, packed.bucket_of(F.col("orig_id")) == side["bucket"]).select("orig_id", packed.rank_in(F.col("orig_id"), side["start"], side["words"], side["ranks"]).alias("compact_id"))
    else:
        kept = ids = keep_map(degree, min_degree)
    n = kept.count()
    if not n:
        top = degree.agg(F.max("degree")).first()[0]
        raise ValueError(f"no node has degree {min_degree} or more; the largest is {top}")
    nodes = _named(graph.nodes, ids)
    if graph.nodes is not None and (lost := missing_nodes(ids, graph.nodes).count()):
        raise ValueError(f"{lost} kept ids have no vertex row")
    edges = packed.ranked_ends(graph.edges.select("eid", "src", "dst"), bits) if small else rekeyed(graph.edges, ids)
    return HostGraph(edges, n, nodes), ids


def missing_nodes(ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """Kept ids without a vertex row."""
    return ids.join(nodes.select(F.col("id").alias("orig_id")), "orig_id", "left_anti")


def degree_report(edges: DataFrame, num_nodes: int, coverage: bool = False) -> dict[str, DataFrame]:
    """Totals, retention ladder and histogram over one degree computation."""
    degree = degrees(edges, edges.sparkSession.range(num_nodes))
    return {"totals": totals(degree), "retention": retention_ladder(degree, edges if coverage else None), "degree_histogram": degree_histogram(degree)}
