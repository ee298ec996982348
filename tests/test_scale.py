"""Work that is dealt out by rows, so that no task's share grows with the tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostweave.operators import graph, losses, ordinals, split
from hostweave.sources import shards
from hostweave.streaming import releases


def edges_of(spark, n, nodes=40):
    return spark.range(n).select(F.col("id").alias("eid"), (F.col("id") * 7 % nodes).alias("src"), (F.col("id") * 11 % (nodes - 1)).alias("dst"))


def test_ranges_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "TASK_ROWS", 50)
    edges = edges_of(spark, 1000)
    both = graph.HostGraph(edges, 40).to_undirected().edges
    rows = [(r["eid"], r["src"], r["dst"]) for r in both.orderBy("eid").collect()]
    want = sorted({p for r in edges.collect() for p in ((r["src"], r["dst"]), (r["dst"], r["src"]))})
    assert rows == [(i, *p) for i, p in enumerate(want)]
    files = both.inputFiles()
    assert len(files) > 20 and ordinals.tasks_for(spark, 1000) == 20 and ordinals.tasks_for(spark, 10) == 4


def test_shards_follow_the_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(shards, "TASK_ROWS", 50)
    folder = f"file://{tmp_path}/shards"
    shards.write_lines(edges_of(spark, 500), folder, "eid", F.concat_ws("\t", "src", "dst"))
    assert len(shards.resolve(spark, folder)) == 10
    got = shards.read_edges(spark, folder).orderBy("eid").collect()
    assert got == edges_of(spark, 500).orderBy("eid").collect()


def test_split_hashes_are_taken_once(spark):
    """Filters on a split read written columns; a hash in a filter is too long a method to be compiled."""
    parts = split.split_edges(edges_of(spark, 3000), 40, eval_edges=20)
    for name in ("train", "val"):
        plan = parts.part(name)._jdf.queryExecution().executedPlan().toString()
        assert "shiftright" not in plan and parts.part(name).count()
    want = split.bounded(split.assigned(edges_of(spark, 3000)), 3000, 42, 20)
    assert sorted(r["eid"] for r in parts.edges.collect()) == sorted(r["eid"] for r in want.collect())


@pytest.mark.parametrize("rows", [10, 1 << 20])
def test_batch_losses_move_each_end_once(spark, monkeypatch, rows):
    monkeypatch.setattr(ordinals, "TASK_ROWS", rows)
    batches = split.batched(edges_of(spark, 200), 64)
    table = losses.initial_vectors(spark, 40, 4)
    out = losses.batch_losses(batches, table, 3)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 3
    vectors = {r["id"]: np.array(r["embedding"], dtype=float) for r in table.collect()}
    own = {}
    for r in batches.collect():
        own.setdefault(r["batch"], []).append(r)
    for r in out.collect():
        some = own.pop(r["batch"])
        ids = sorted({x for e in some for x in (e["src"], e["dst"])})
        draws = [(e, ids[(e["eid"] * 3 + k + 42) * 0x9E3779B97F4A7C15 % 2**64 % len(ids)]) for e in some for k in range(3)]
        pos = np.mean([np.logaddexp(0, -vectors[e["src"]] @ vectors[e["dst"]]) for e in some])
        neg = np.mean([np.logaddexp(0, vectors[e["src"]] @ vectors[i]) for e, i in draws])
        assert r["n"] == len(some) == 64 and abs(r["loss"] - pos - neg) < 1e-9
    assert not own


def test_lifecycles_call_no_python_a_host(spark, tmp_path):
    """A release of several files arrives in one micro-batch; one that comes again replaces itself."""
    for rows in ([("a", 0, "r0", 9), ("b", 0, "r0", 2)], [("a", 2, "r2", 4)], [("a", 0, "r0", 1)]):
        spark.createDataFrame(rows, releases.ARRIVAL).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        found = releases.sightings(releases.release_stream(spark, f"{tmp_path}/in", files=100))
        assert "Pandas" not in found._jdf.queryExecution().logical().toString()
        releases.stored_updates(found, f"{tmp_path}/updates", f"{tmp_path}/checkpoint")
    got = {r["host_key"]: (r["local_node_ids"], r["state"]) for r in releases.as_of(spark.read.parquet(f"{tmp_path}/updates"), 2).collect()}
    assert got["a"] == ({"r0": 1, "r2": 4}, "reappeared") and got["b"][0] == {"r0": 2}
