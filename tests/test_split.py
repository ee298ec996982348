import numpy as np
import pytest
from pyspark.sql import functions as F

from hostweave.functions import hashing
from hostweave.operators import split
from hostweave.sources import store


def identity(spark, n):
    return spark.range(n).select(F.col("id").alias("eid"), F.col("id").alias("src"), F.col("id").alias("dst"))


@pytest.mark.parametrize("start", [0, 13_070_000_000, (1 << 62) + 12345])
def test_hash_is_unsigned_multiplication(spark, start):
    got = spark.range(start, start + 500).select("id", hashing.split_bucket(F.col("id"), 42).alias("b"), hashing.top24(F.col("id"), 42).alias("t"), hashing.hash_mod(F.col("id"), 42, 3_500).alias("m")).collect()
    for r in got:
        h = (r["id"] + 42) * hashing.MULTIPLIER % 2**64
        assert (r["b"], r["t"], r["m"]) == (h % 10, h >> 40, h % 3500)


def test_fractions_and_partition(spark):
    parts = split.assigned(identity(spark, 20_000))
    counts = {r["split"]: r["count"] / 20_000 for r in parts.groupBy("split").count().collect()}
    assert 0.09 < counts["test"] < 0.11 and 0.09 < counts["val"] < 0.11 and 0.78 < counts["train"] < 0.82
    for n in (1, 3, 17):
        assert split.assigned(identity(spark, 3000).repartition(n)).exceptAll(split.assigned(identity(spark, 3000))).count() == 0


def test_stripes_slices_and_store(spark, tmp_path):
    parts = split.split_edges(identity(spark, 5000), 5000, eval_edges=0)
    stripes = [r["count"] for r in split.worker_stripes(parts, 4).groupBy("rank").count().collect()]
    assert len(stripes) == 4 and max(stripes) - min(stripes) <= 1
    total = sum(stripes)
    slices = {r["rank"]: (r["lo"], r["hi"]) for r in split.worker_slices(parts, 4).groupBy("rank").agg(F.min("train_ordinal").alias("lo"), F.max("train_ordinal").alias("hi")).collect()}
    assert slices == {r: (total * r // 4, total * (r + 1) // 4 - 1) for r in range(4)}
    meta = store.save_split(parts, f"file://{tmp_path}/split")
    assert meta["train_total"] + meta["val_count"] + meta["test_count"] == 5000 == meta["n_edges"]
    assert store.load_split(spark, f"file://{tmp_path}/split").part("val").count() == meta["val_count"]


def test_a_worker_reads_its_slice(spark, tmp_path):
    store.save_split(split.split_edges(identity(spark, 5000), 5000, eval_edges=0), f"file://{tmp_path}/s")
    stored = store.load_split(spark, f"file://{tmp_path}/s")
    total, got = stored.part("train").count(), []
    for rank in range(3):
        rows = split.worker_slice(stored, 3, rank)
        assert "GreaterThanOrEqual(train_ordinal" in rows._jdf.queryExecution().executedPlan().toString()
        got.append([r["train_ordinal"] for r in rows.collect()])
    assert sorted(sum(got, [])) == list(range(total)) and [min(x) for x in got] == [0, total // 3, total * 2 // 3]


@pytest.mark.parametrize("step", [1, 3, 13])
def test_selection_by_refined_counts(spark, monkeypatch, step):
    """Ids that share a hash (they lie 2 ** 39 apart) are taken by id; no exchange gathers the sample."""
    monkeypatch.setattr(split, "STEP", step)
    ids = [i + (k << 39) for i in range(60) for k in range(i % 4 + 1)]
    edges = spark.createDataFrame([(i, i, i) for i in ids], "eid long, src long, dst long")
    order = sorted(ids, key=lambda i: ((i + 42) * hashing.MULTIPLIER % 2**39, i))
    for cap in (1, 2, 3, 50, 51, 52, len(ids) - 1, len(ids), len(ids) + 5):
        out = split.subsample(edges, cap)
        assert sorted(r["eid"] for r in out.collect()) == sorted(order[:cap])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_bounded_and_subsampled(spark):
    edges = identity(spark, 20_000)
    kept = split.bounded(split.assigned(edges), 20_000, cap=200)
    counts = {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()}
    assert 200 < counts["test"] <= 600 and 200 < counts["val"] <= 600
    assert split.subsample(edges, 1000).count() == 1000
    assert split.subsample(edges, 0).count() == 20_000
    assert split.subsample(edges, 1000, 1).exceptAll(split.subsample(edges.repartition(5), 1000, 1)).count() == 0


def test_minibatches_recover_edges(spark):
    edges = spark.range(100).select(F.col("id").alias("eid"), F.col("id").alias("src"), (F.col("id") + 1000).alias("dst"))
    rows = split.minibatches(edges, 16).collect()
    assert len({r["batch"] for r in rows}) == 6 and len(rows) == 96
    for b in range(6):
        own = [r for r in rows if r["batch"] == b]
        ids = np.unique([x for r in own for x in (r["src"], r["dst"])])
        assert all(ids[r["local_src"]] == r["src"] and ids[r["local_dst"]] == r["dst"] for r in own)
