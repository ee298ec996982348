from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostweave import api
from hostweave.operators.training import Config
from hostweave.sources import scratch


def test_from_shards_to_release(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "e").mkdir()
    edges = [(i, (i * k + 1) % 60) for k in range(1, 9) for i in range(60)]
    for part in (0, 1):
        (tmp_path / f"v/{part}.txt").write_text("".join(f"{i}\tcom.site.h{i}\n" for i in range(30 * part, 30 * part + 30)))
        (tmp_path / f"e/{part}.txt").write_text("".join(f"{a}\t{b}\n" for a, b in edges[240 * part : 240 * part + 240]))
    v, e, root = str(tmp_path / "v"), str(tmp_path / "e"), f"file://{tmp_path}"
    report = api.degree_distribution(spark, e, 60, f"{root}/report.json", edge_coverage=True)
    assert report["total_edges"] == 480 and report["retention"][0]["induced_edges"] == 480
    meta = api.min_degree_slice(spark, v, e, f"{root}/slice", 8)
    assert (meta["num_nodes"], meta["num_edges"]) == (60, 480)
    split = api.split_cache(spark, f"{root}/slice", f"{root}/split", eval_edges=0)
    assert split["train_total"] + split["val_count"] + split["test_count"] == 480
    records = api.release_manifest(spark, f"{root}/slice", f"{root}/m1", "rel-1", ["c1"])
    assert records.count() == 60 and records.where("domain_key = 'site.com'").count() == 60
    assert {r["state"] for r in api.cross_release_index(spark, [f"{root}/m1"]).collect()} == {"new"}
    table, history = api.train(spark, f"{root}/split", f"{root}/t", Config(dim=4, epochs=1, blocks=2, eval_neg=5))
    assert table.count() == 60 and len(history) == 1
    kept = Path(scratch.shared_dir(spark).removeprefix("file://")) / "hostweave"
    assert not list(kept.glob("run-*")) and table.agg(F.count("embedding")).first()[0] == 60  # results don't read what went
    assert set(api.release_sizing(spark, 10, 5)) == {"host", "domain"} and "pyspark" in api.info()


def test_a_run_removes_what_it_wrote(spark):
    outside = scratch.cut(spark.range(3), "outside")
    with pytest.raises(RuntimeError), scratch.run_folder(spark) as folder:
        inside = scratch.cut(spark.range(3), "inside")
        with scratch.run_folder(spark) as same:
            assert same == folder
        assert inside.count() == 3 and Path(folder.removeprefix("file://")).exists()
        raise RuntimeError
    assert not Path(folder.removeprefix("file://")).exists() and outside.count() == 3
