import numpy as np
from pyspark.sql import functions as F

from hostweave.operators import losses
from hostweave.operators import training as t
from hostweave.streaming import degrees as streaming


def test_rounds_are_disjoint():
    every = [p for r in t.rounds(5) for p in r]
    assert sorted(every) == [(a, b) for a in range(5) for b in range(a, 5)]
    assert all(len({b for p in r for b in p}) == sum(len(set(p)) for p in r) for r in t.rounds(5))


def test_losses_and_schedule():
    assert abs(t.inbatch_loss(np.zeros(3), np.zeros((3, 2))) - 2 * np.log(2)) < 1e-12
    assert abs(t.binary_loss(np.array([0.0]), np.array([1.0])) - np.log(2)) < 1e-12
    config = t.Config(lr=0.1, epochs=4)
    assert t.learning_rate(config, 1) == 0.1 and t.learning_rate(config, 4) < 0.03


def test_blocks_follow_from_the_size():
    assert t.block_count(1000, t.Config(dim=16)) == 1 and t.block_count(1000, t.Config(blocks=3)) == 3
    n = t.block_count(279_000_000, t.Config(dim=128))
    assert n > 500 and 2 * 279_000_000 * 128 * 12 / n <= t.TASK_BYTES


def test_weighted_loss(spark):
    rows = spark.createDataFrame([(1, 0.5), (3, 1.5), (0, 9.0)], "n long, loss double")
    assert losses.weighted_loss(rows).first()["loss"] == 1.25
    assert losses.weighted_loss(rows.where("n = 0")).first()["loss"] == 0.0


def test_starting_vectors_are_normal(spark):
    x = np.array([r["embedding"] for r in losses.initial_vectors(spark, 4000, 8).collect()]) / 0.1
    assert abs(x.mean()) < 0.03 and abs(x.std() - 1) < 0.02 and 0.64 < (np.abs(x) < 1).mean() < 0.72
    assert np.abs(np.corrcoef(x.T) - np.eye(8)).max() < 0.08


def test_a_task_streams_its_edges(spark):
    """All edges of a bucket are seen once, in batches, whatever way they come in."""
    rng = np.random.default_rng(3)
    edges = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 40, (500, 2)))], "eid long, src long, dst long")
    config = t.Config(dim=4, batch=64, train_neg=2)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = {}
    for records in (7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        out = t._round(edges, t.initial(spark, 40, config), [(0, 2), (1, 1)], 3, config, 0.1, 1, 0).collect()
        seen[records] = sorted((r["id"], tuple(r["embedding"])) for r in out)
        inside = edges.where("(src % 3 <> 1 AND dst % 3 <> 1 AND src % 3 <> dst % 3) OR (src % 3 = 1 AND dst % 3 = 1)").count()
        assert sum(r["n"] for r in out) == inside and len(out) == 40 and 0 < inside < 500
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert seen[7] == seen[10_000]


def test_planted_communities_are_learnt_and_resumed(spark, tmp_path):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for c in range(8) for a, b in rng.integers(0, 25, (150, 2)) + 25 * c]
    edges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "eid long, src long, dst long")
    held = edges.where(F.col("eid") % 10 == 0)
    config = t.Config(dim=8, epochs=2, batch=64, lr=0.1, train_neg=5, blocks=2, eval_neg=50)
    folder = f"file://{tmp_path}/run"
    first = t.train_embeddings(edges.where(F.col("eid") % 10 != 0), 200, config, folder, held, stop=lambda: True)[1]
    assert len(first) == 1
    table, history = t.train_embeddings(edges.where(F.col("eid") % 10 != 0), 200, config, folder, held)
    assert [h["epoch"] for h in history] == [1, 2] and history[1]["loss"] < history[0]["loss"]
    assert table.count() == 200 and max(h["mrr"] for h in history) > 0.15


def test_running_degrees(spark, tmp_path):
    spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "src long, dst long").write.parquet(f"{tmp_path}/in")
    query = streaming.running_degrees(streaming.edge_stream(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("deg").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    got = {r["id"]: (r["in_degree"], r["out_degree"], r["degree"]) for r in spark.sql("SELECT * FROM deg").collect()}
    assert got == {0: (0, 2, 2), 1: (2, 1, 3), 2: (1, 0, 1)}


def test_many_edges_make_many_buckets(spark, tmp_path, monkeypatch):
    """Buckets are bounded by edges too; each round keeps every block busy; each edge is seen once an epoch."""
    assert t.block_count(1000, t.Config(dim=16), 173_000_000) >= 9
    assert [len(r) for r in t.rounds(8)] == [5, 4] * 4 and [len(r) for r in t.rounds(7)] == [4] * 7
    monkeypatch.setattr(t, "BUCKET_EDGES", 100)
    rng = np.random.default_rng(5)
    edges = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 60, (600, 2)))], "eid long, src long, dst long")
    seen = []
    real = t._round
    monkeypatch.setattr(t, "_round", lambda e, s, pairs, *rest: (seen.append((e.count(), len(pairs))), real(e, s, pairs, *rest))[1])
    table, _ = t.train_embeddings(edges, 60, t.Config(dim=4, epochs=1, batch=32, train_neg=2), f"file://{tmp_path}/run")
    assert len(seen) == 4 and sum(n for n, _ in seen) == 600 and table.count() == 60


def test_sums_by_index():
    rng = np.random.default_rng(6)
    index, rows = np.concatenate([np.arange(50), rng.integers(0, 50, 300)]), rng.normal(size=(350, 3))
    want = np.zeros((50, 3))
    np.add.at(want, index, rows)
    assert np.abs(t.summed(index, rows, 50) - want).max() < 1e-12


def test_a_round_sends_no_null_lists(spark, monkeypatch):
    """Sizing up null lists row by row took five times as long as the training itself."""
    sent = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, schema: sent.append(self) or self)
    edges = spark.range(50).selectExpr("id AS eid", "id AS src", "id + 1 AS dst")
    t._round(edges, t.initial(spark, 60, t.Config(dim=4)), [(0, 0)], 1, t.Config(dim=4), 0.1, 1, 0)
    assert sent[0].where("embedding IS NULL OR m IS NULL OR v IS NULL").count() == 0 and sent[0].count() == 110
