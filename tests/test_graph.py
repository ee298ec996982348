import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostweave.operators import graph as g
from hostweave.operators import packed
from hostweave.operators.ordinals import with_ordinal
from hostweave.sources import npy, shards, store

NAMES = ["com.a", "com.b", "org.c", "net.d", "uk.co.bbc"]
EDGES = [(0, 1), (0, 2), (1, 2), (3, 0), (4, 1)]


@pytest.fixture
def folder(tmp_path):
    for kind in ("vertices", "edges"):
        (tmp_path / kind).mkdir()
    with gzip.open(tmp_path / "vertices/part-0.gz", "wt") as f:
        f.write("".join(f"{i}\t{n}\n" for i, n in enumerate(NAMES[:3])))
    with gzip.open(tmp_path / "vertices/part-1.gz", "wt") as f:
        f.write("".join(f"{i + 3}\t{n}\n" for i, n in enumerate(NAMES[3:])))
    with gzip.open(tmp_path / "edges/part-0.gz", "wt") as f:
        f.write("".join(f"{a}\t{b}\n" for a, b in EDGES[:2]) + "\n")
    with gzip.open(tmp_path / "edges/part-1.gz", "wt") as f:
        f.write("".join(f"{a}\t{b}\n" for a, b in EDGES[2:]))
    return tmp_path


def test_shards_keep_global_order(spark, folder):
    edges = shards.read_edges(spark, str(folder / "edges")).orderBy("eid").collect()
    assert [tuple(r) for r in edges] == [(i, a, b) for i, (a, b) in enumerate(EDGES)]
    vertices = shards.read_vertices(spark, str(folder / "vertices")).orderBy("id").collect()
    assert [tuple(r) for r in vertices] == list(enumerate(NAMES))
    assert shards.count_lines(spark, str(folder / "vertices")) == 5
    with pytest.raises(FileNotFoundError):
        shards.resolve(spark, str(folder / "none*"))


@pytest.mark.parametrize(("k", "kept", "pairs"), [(2, [0, 1, 2], [(0, 1), (0, 2), (1, 2)]), (3, [0, 1], [(0, 1)]), (1, [0, 1, 2, 3, 4], EDGES)])
def test_slice(spark, folder, k, kept, pairs):
    graph = g.HostGraph(shards.read_edges(spark, str(folder / "edges")), 5, shards.read_vertices(spark, str(folder / "vertices")))
    assert [r["degree"] for r in graph.degrees().orderBy("id").collect()] == [3, 3, 2, 1, 1]
    part, ids = g.min_degree_slice(graph, k)
    assert [r["orig_id"] for r in ids.orderBy("compact_id").collect()] == kept
    assert [(r["src"], r["dst"]) for r in part.edges.orderBy("eid").collect()] == pairs
    assert [r["name"] for r in part.nodes.orderBy("id").collect()] == [NAMES[i] for i in kept]


def test_slice_guards(spark, folder):
    graph = g.HostGraph(shards.read_edges(spark, str(folder / "edges")), 5)
    with pytest.raises(ValueError, match="largest is 3"):
        g.min_degree_slice(graph, 99)
    with pytest.raises(ValueError, match="at least 1"):
        g.min_degree_slice(graph, 0)
    with pytest.raises(ValueError, match="must lie in"):
        g.HostGraph.from_edges(graph.edges, 3)


@pytest.mark.parametrize("packed", [False, True])
def test_lines_are_numbered_where_they_are_read(spark, tmp_path, packed):
    names = ["b 1.txt", "a%41.txt", "c.txt"]
    want = []
    for i, name in enumerate(sorted(names)):
        text = "".join(f"{i} {k} {'x' * (k % 50)}\n" + "\n \t\n" * (k % 3 == 0) for k in range(700))
        want += [x for x in text.split("\n") if x.strip()]
        if packed:
            with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
                f.write(text)
        else:
            (tmp_path / name).write_text(text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        out = shards.lines(spark, str(tmp_path))
        assert [tuple(r) for r in out.orderBy("ordinal").collect()] == list(enumerate(want))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Sort" not in plan and out.rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_toy_graph_views(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, 1), (1, 0, 2), (2, 1, 2), (3, 3, 0)], "eid long, src long, dst long")
    features = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "id long, features array<float>")
    graph = g.HostGraph.from_edges(rows, nodes=features)
    assert graph.num_nodes == 4
    got = graph.degrees().orderBy("id").collect()
    assert [r["out_degree"] for r in got] == [2, 1, 0, 1]
    assert [r["in_degree"] for r in got] == [1, 1, 2, 0]
    assert [(r["id"], r["offset"], r["neighbors"]) for r in graph.adjacency().orderBy("id").collect()] == [(0, 0, [1, 2]), (1, 2, [2]), (2, 3, []), (3, 3, [0])]
    assert graph.to_undirected().num_edges() == 8
    assert [(r["src"], r["dst"]) for r in graph.where_edges(F.col("eid") % 2 == 0).edges.orderBy("eid").collect()] == [(0, 1), (1, 2)]
    store.save_graph(graph, f"file://{tmp_path}/graph", source="toy")
    again = store.load_graph(spark, f"file://{tmp_path}/graph")
    assert again.num_nodes == 4 and again.nodes.orderBy("id").first()["features"] == [0.0, 1.0]
    assert again.edges.exceptAll(rows).count() == 0 == rows.exceptAll(again.edges).count()


@pytest.mark.parametrize("buckets", [1, 3, 17])
def test_ordinals_do_not_depend_on_partitions(spark, buckets):
    rows = spark.range(500).select((F.col("id") * 7919 % 503).alias("x"), (F.col("id") % 5).alias("y")).repartition(buckets)
    got = with_ordinal(rows, ["x", "y"], buckets=buckets).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(500))
    assert [(r["x"], r["y"]) for r in got] == sorted((i * 7919 % 503, i % 5) for i in range(500))


def test_empty_graph(spark):
    none = spark.createDataFrame([], "eid long, src long, dst long")
    graph = g.HostGraph.from_edges(none)
    assert graph.num_nodes == 0 and graph.degrees().count() == 0
    assert g.degrees(none, spark.range(3)).agg(F.sum("degree")).first()[0] == 0
    assert [r["n_nodes"] for r in g.degree_histogram(g.degrees(none, spark.range(3))).orderBy("deg_lo").collect()] == [3] + [0] * 12
    assert {r["induced_edges"] for r in g.retention_ladder(g.degrees(none, spark.range(3)), none).collect()} == {0}


def test_npy_source(spark, tmp_path):
    matrix = np.arange(20, dtype=np.float32).reshape(5, 4)
    np.save(tmp_path / "m.npy", matrix)
    np.save(tmp_path / "v.npy", matrix[0])
    spark.dataSource.register(npy.NpySource)
    got = spark.read.format("npy").option("path", str(tmp_path / "m.npy")).option("rows", 2).load().orderBy("id").collect()
    assert [list(r["embedding"]) for r in got] == matrix.tolist()
    np.save(tmp_path / "f.npy", np.asfortranarray(matrix))
    got = spark.read.format("npy").option("path", f"file://{tmp_path}/f.npy").option("rows", 2).load().orderBy("id").collect()
    assert [list(r["embedding"]) for r in got] == matrix.tolist()
    with pytest.raises(Exception, match="two-dimensional"):
        spark.read.format("npy").option("path", str(tmp_path / "v.npy")).load().collect()


def test_buckets_spare_the_edges_exchange(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 60, (900, 2)))], "eid long, src long, dst long")
    graph = g.HostGraph(rows, 61)
    store.save_graph(graph, f"file://{tmp_path}/g", buckets=5)
    again = store.load_graph(spark, f"file://{tmp_path}/g")
    out = again.degrees()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, graph.degrees().collect()))
    assert again.edges.exceptAll(rows).count() == 0 == rows.exceptAll(again.edges).count()
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = again.degrees()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2 and plan.split("Exchange")[1].split("+- ")[1].startswith("Range"), plan


@pytest.mark.parametrize("bound", [3, 7, 10_000])
def test_a_hub_is_many_rows(spark, bound):
    rng = np.random.default_rng(6)
    pairs = [(4, int(x)) for x in rng.integers(0, 50, 400)] + [(int(a), int(b)) for a, b in rng.integers(0, 50, (100, 2))]
    order = rng.permutation(len(pairs))
    graph = g.HostGraph(spark.createDataFrame([(i, *pairs[k]) for i, k in enumerate(order.tolist())], "eid long, src long, dst long"), 52)
    for outgoing in (True, False):
        whole = {r["id"]: (r["offset"], r["neighbors"]) for r in graph.adjacency(outgoing).collect()}
        rows = sorted(graph.adjacency_chunks(outgoing, bound).collect(), key=lambda r: r["offset"])
        assert max(len(r["neighbors"]) for r in rows) <= bound
        joined = {}
        for r in rows:
            at, so_far = joined.setdefault(r["id"], (r["offset"], []))
            assert at + len(so_far) == r["offset"]
            so_far += r["neighbors"]
        assert joined == {i: (at, x) for i, (at, x) in whole.items() if x}
        assert {r["id"]: (r["offset"], r["n"]) for r in graph.adjacency_offsets(outgoing).collect()} == {i: (at, len(x)) for i, (at, x) in whole.items()}


def test_packed_sets_and_classes(spark, monkeypatch):
    rng = np.random.default_rng(7)
    ids = sorted({0, 1, 63, 64, 32767, 32768, 99_999, *rng.integers(0, 100_000, 3000).tolist()})
    bits = packed.packed_set(spark.createDataFrame([(i,) for i in ids], "id long"))
    every = spark.range(100_000).join(bits, packed.bucket_of(F.col("id")) == bits["bucket"]).select("id", packed.rank_in(F.col("id"), bits["start"], bits["words"], bits["ranks"]).alias("rank")).where("rank IS NOT NULL")
    assert sorted(map(tuple, every.collect())) == [(i, k) for k, i in enumerate(ids)]
    classes = packed.packed_classes(spark.range(70_000).select("id", (F.col("id") * 7 % 16).cast("int").alias("at")))
    got = spark.range(70_000).join(classes, packed.bucket_of(F.col("id")) == classes["bucket"]).select("id", packed.class_in(F.col("id"), classes["words"]).alias("at"))
    assert got.count() == 70_000 and got.where("at <> id * 7 % 16").count() == 0


def test_slices_and_ladders_are_the_same_beyond_what_fits(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pairs = [(0, int(x)) for x in rng.integers(0, 200, 300)] + [(int(a), int(b)) for a, b in rng.integers(0, 200, (600, 2))]  # a hub
    graph = g.HostGraph(spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "eid long, src long, dst long"), 40_000)
    out = {}
    monkeypatch.setattr(packed, "BLOCK", 15)  # two blocks
    monkeypatch.setattr(packed, "PART_EDGES", 100)
    for limit in (packed.BROADCAST_BYTES, 0):
        monkeypatch.setattr(packed, "BROADCAST_BYTES", limit)
        part, ids = g.min_degree_slice(graph, 8)
        out[limit] = [sorted(map(tuple, x.collect())) for x in (part.edges, ids, g.retention_ladder(graph.degrees(), graph.edges))]
        if limit:
            plan = part.edges._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and plan.split("Initial Plan")[0].count("BroadcastHashJoin") == 2
    assert out[0] == out[256 << 20] and len(out[0][0]) > 50


@pytest.mark.parametrize(("block", "part_edges"), [(15, 10), (16, 1000), (20, 7)])
def test_a_grid_of_blocks_is_one_exchange(spark, block, part_edges):
    rng = np.random.default_rng(9)
    n = 150_000
    pairs = [(70_000, int(x)) for x in rng.integers(0, n, 400)] + [(int(a), int(b)) for a, b in rng.integers(0, n, (300, 2))]  # a hub
    edges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "eid long, src long, dst long")
    classes = packed.packed_classes(spark.range(n).select("id", (F.col("id") * 13 % 16).cast("int").alias("at")))
    out = packed.gridded_class(edges, classes, n, block, part_edges)
    assert sorted(r["at"] for r in out.collect()) == sorted(min(a * 13 % 16, b * 13 % 16) for a, b in pairs)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_many_thresholds(spark):
    edges = spark.createDataFrame([(i, i % 5, i % 7) for i in range(200)], "eid long, src long, dst long")
    degree = g.degrees(edges, spark.range(7))
    many = tuple(range(1, 41, 2))
    few = {r["min_degree"]: r["induced_edges"] for r in g.induced_edge_counts(edges, degree, many[:12]).collect()}
    got = {r["min_degree"]: r["induced_edges"] for r in g.induced_edge_counts(edges, degree, many).collect()}
    assert len(got) == 20 and few.items() <= got.items()
