import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hostweave import api
from hostweave.functions import identity, suffixes
from hostweave.operators import contract, neighbors, releases, vectors
from hostweave.operators import graph as g
from hostweave.sources import export, shardfiles, store


def domains(spark, hosts, rules=None):
    out = suffixes.with_domain(spark.createDataFrame([(h,) for h in hosts], "host_key string"), rules)
    return {r["host_key"]: r["domain_key"] for r in out.collect()}


def test_host_and_domain_keys(spark):
    rows = [("com.example.www", "www.example.com", "example.com"), ("  COM.Example.WWW. ", "www.example.com", "example.com"), ("uk.co.bbc.www", "www.bbc.co.uk", "bbc.co.uk"), ("com", "com", "com"), ("uk.co", "co.uk", "co.uk"), ("", "", "")]
    df = spark.createDataFrame([(r[0],) for r in rows], "name string").select("name", identity.host_key(F.col("name")).alias("h"))
    got = {r["name"]: (r["h"], r["d"]) for r in suffixes.with_domain(df, host="h", name="d").collect()}
    assert got == {n: (h, d) for n, h, d in rows}
    plain = spark.createDataFrame([("WWW.Example.com.",)], "name string").select(identity.host_key(F.col("name"), reverse=False)).first()[0]
    assert plain == "www.example.com"


def plain_domain(host, rules):
    """The list's algorithm, label by label."""
    labels = host.split(".")
    length = 0
    for n in range(1, len(labels) + 1):
        kind = rules.get(".".join(labels[-n:]), 0)
        wild = rules.get(".".join(labels[-n + 1 :]), 0) & 2 if n > 1 else 0
        if kind & 4:
            return ".".join(labels[-n:])
        length = n if kind & 1 or wild else length
    return host if not length or length >= len(labels) or not labels[-length - 1] else ".".join(labels[-length - 1 :])


def test_every_rule_of_the_list(spark):
    rules = suffixes.parsed(suffixes.listed_text(spark))
    assert len(rules) > 6000 and {"ck": 2, "www.ck": 4, "co.uk": 1, "k12.ca.us": 1, "kawasaki.jp": 2, "city.kawasaki.jp": 4}.items() <= rules.items()
    hosts = {f"{head}{suffix}" for suffix in rules for head in ("", "a.", "x.y.")} | {"127.0.0.1", "a.b.nosuch", "nosuch", "..com", "a..com", "COM", "::1", "a.公司.cn", "a.xn--55qx5d.cn"}
    got = domains(spark, sorted(hosts))
    assert got == {h: plain_domain(h, rules) for h in hosts}
    assert got["a.b.nosuch"] == "a.b.nosuch" and got["a..com"] == "a..com" and got["a.公司.cn"] == "a.公司.cn" and got["a.xn--55qx5d.cn"] == "a.xn--55qx5d.cn"
    assert domains(spark, [None, "x.com"]) == {None: None, "x.com": "x.com"}


def test_rules_of_a_file(spark, tmp_path):
    (tmp_path / "rules").write_text("// a comment\ncom\n*.ck\n!www.ck\n")
    rules = suffixes.suffix_rules(spark, f"file://{tmp_path}/rules")
    want = {"a.b.com": "b.com", "x.y.ck": "x.y.ck", "www.ck": "www.ck", "q.www.ck": "www.ck", "127.0.0.1": "127.0.0.1", "y.ck": "y.ck", "a.b.co.uk": "a.b.co.uk"}
    assert domains(spark, list(want), rules) == want and (rules.count, rules.depth) == (3, 2)
    (tmp_path / "none").write_text("// nothing\n")
    with pytest.raises(ValueError, match="no suffix rule"):
        suffixes.suffix_rules(spark, f"file://{tmp_path}/none")


def test_domains_move_no_host(spark):
    hosts = spark.range(10).select(F.concat(F.lit("a.h"), F.col("id").cast("string"), F.lit(".co.uk")).alias("host_key"))
    out = suffixes.with_domain(hosts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan and "BroadcastHashJoin" in plan
    assert out.where("domain_key = concat('h', split(host_key, '[.]')[1])").count() == 0 and out.select("domain_key").distinct().count() == 10


def test_evidence(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (0, 2), (0, 0)], "i long, o long")
    got = [tuple(r) for r in df.select(identity.evidence_cohort(F.col("i"), F.col("o")), identity.confidence_bucket(F.col("i"), F.col("o"))).collect()]
    assert got == [("bidirectional", "high"), ("in_only", "medium"), ("out_only", "medium"), ("isolated", "low")]


def three(spark):
    key = identity.host_key(F.col("name"))
    return [(f"rel-{i}", spark.createDataFrame([(f"com.{c}", k) for k, c in enumerate(names)], "name string, local_node_id long").select(key.alias("host_key"), "local_node_id")) for i, names in enumerate(("abcd", "bae", "fcae"), start=1)]


def test_lifecycle(spark):
    index = releases.release_index(three(spark))
    got = {r["host_key"]: r for r in index.collect()}
    assert {k: r["state"] for k, r in got.items()} == {"a.com": "active", "e.com": "active", "f.com": "new", "c.com": "reappeared", "b.com": "missing", "d.com": "missing"}
    assert got["a.com"]["local_node_ids"] == {"rel-1": 0, "rel-2": 1, "rel-3": 2}
    assert (got["c.com"]["first_release"], got["b.com"]["last_seen_release"]) == ("rel-1", "rel-2")
    assert {r["state"]: r["n"] for r in releases.state_counts(index).collect()} == {"active": 2, "new": 1, "reappeared": 1, "missing": 2}
    assert {r["state"] for r in releases.release_index(three(spark)[:1]).collect()} == {"new"}
    with pytest.raises(ValueError, match="duplicate release"):
        releases.release_index([three(spark)[0]] * 2)
    with pytest.raises(ValueError, match="at least one"):
        releases.release_index([])


def test_manifest(spark, tmp_path):
    names = spark.createDataFrame([(0, "com.a"), (1, "com.b"), (2, "com.c"), (3, "com.d")], "id long, name string")
    edges = spark.createDataFrame([(0, 0, 1), (1, 0, 2), (2, 1, 0)], "eid long, src long, dst long")
    rec = releases.records(names, g.HostGraph(edges, 4).degrees())
    got = {r["host_key"]: (r["cohort"], r["confidence"], r["is_dangling"]) for r in rec.collect()}
    assert got["c.com"] == ("in_only", "medium", 1) and got["d.com"] == ("isolated", "low", 1)
    store.save_manifest(rec, f"file://{tmp_path}/m", "rel-1", ["crawl-1"])
    head, again = store.load_manifest(spark, f"file://{tmp_path}/m")
    assert head["release_id"] == "rel-1" and again.exceptAll(rec).count() == 0 == rec.exceptAll(again).count()
    twice = spark.createDataFrame([(0, "com.a"), (1, "com.a")], "id long, name string")
    with pytest.raises(ValueError, match="duplicate host key"):
        releases.records(twice, g.HostGraph(edges.limit(0), 2).degrees())
    with pytest.raises(ValueError, match="1 to 3"):
        releases.check_crawls([])


def test_export(spark, tmp_path):
    matrix = (np.random.default_rng(0).normal(size=(5, 4)) * 3).astype(np.float32)
    matrix[4] = 0
    vec = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "row_id long, embedding array<float>")
    names = spark.createDataFrame([(i, f"com.h{i}") for i in range(5)], "row_id long, name string")
    made = export.export_shards(vec, names, str(tmp_path), "rel-1", ["c1"], "v1", rows_per_shard=2)
    assert [e["n_rows"] for e in made["shards"] if e["kind"] == "vectors"] == [2, 2, 1]
    for e in made["shards"]:
        assert hashlib.sha256((tmp_path / e["filename"]).read_bytes()).hexdigest() == e["sha256"]
        values = np.array(pq.read_table(tmp_path / e["filename"]).column("embedding").to_pylist(), dtype=np.float32)
        want = matrix[e["row_start"] : e["row_end"]]
        want = want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-30)
        assert np.allclose(values, want, atol=1e-6 if e["kind"] == "vectors" else 1e-3)
    stored = json.loads((tmp_path / "manifest.json").read_text())
    assert stored == made and list(stored["columns"]) == ["row_id", "host_key", "domain_key", "embedding"] and (stored["num_shards"], stored["dim"], stored["canonical_precision"]) == (3, 4, "float32")
    files = {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()}
    assert files == {e["filename"] for e in made["shards"]} | {"manifest.json"}
    extra = names.unionByName(spark.createDataFrame([(5, "com.x")], "row_id long, name string"))
    with pytest.raises(ValueError, match="misaligned"):
        export.export_shards(vec, extra, str(tmp_path), "r", ["c"], "v")
    with pytest.raises(ValueError, match="misaligned"):
        export.export_shards(vec, names.where("row_id < 4"), str(tmp_path), "r", ["c"], "v")
    with pytest.raises(ValueError, match="precision"):
        export.export_shards(vec, names, str(tmp_path), "r", ["c"], "v", precision="bf16")


def five(spark):
    vec = spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], "row_id long, embedding array<float>")
    return vec, spark.createDataFrame([(i, f"com.h{i}") for i in range(5)], "row_id long, name string")


def test_export_of_some_rows_as_they_are(spark, tmp_path):
    vec, names = five(spark)
    made = export.export_shards(vec, names, f"file://{tmp_path}", "r", "c1, c2", "v", rows_per_shard=2, precision="fp16", normalize=False, limit=3, meta={"encoder": "x", "best_val_mrr": 0.5, "loss": 1})
    assert [(e["kind"], e["row_start"], e["row_end"]) for e in made["shards"]] == [("vectors", 0, 2), ("vectors", 2, 3)]
    assert (made["num_rows"], made["normalized"], made["canonical_precision"], made["metrics"], made["source_crawls"]) == (3, False, "float16", {"best_val_mrr": 0.5}, ["c1", "c2"])
    table = pq.read_table(tmp_path / "vectors")
    assert table.schema.field("embedding").type == pa.list_(pa.float16(), 2) and sorted(table.column("embedding").to_pylist()) == [[0, 2], [1, 2], [2, 2]]


def test_failed_and_repeated_tasks_leave_no_file(spark, tmp_path):
    options = {"path": str(tmp_path), "tiers": json.dumps({"vectors": "float32"}), "shards": "2", "rows": "4", "manifest": "{}"}
    writer = shardfiles.ShardWriter(options)
    rows = lambda shard: pa.record_batch([pa.array([shard] * 2), pa.array([2 * shard, 2 * shard + 1]), pa.array(["h"] * 2), pa.array(["d"] * 2), pa.array([[1.0], [2.0]], pa.list_(pa.float32()))], ["shard", "row_id", "host_key", "domain_key", "embedding"])

    def broken():
        yield rows(0)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        writer.write(broken())
    writer.write(iter([rows(1)]))  # an attempt whose message doesn't count
    writer.commit([writer.write(iter([rows(0)])), None, writer.write(iter([rows(1)])), writer.write(iter([]))])
    assert {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*")} == {"manifest.json", "vectors", "vectors/emb-00000-of-00002.parquet", "vectors/emb-00001-of-00002.parquet"}
    again = shardfiles.ShardWriter(options)
    with pytest.raises(ValueError, match="holds 2 rows"):
        again.commit([again.write(iter([rows(0)]))])
    again.abort([])
    assert not (tmp_path / "_staging").exists()


def test_failed_export_leaves_nothing(spark, tmp_path, monkeypatch):
    vec, names = five(spark)
    whole = shardfiles.shard_table

    def breaks(rows, kind):
        if 4 in rows.column("row_id").to_pylist():
            raise RuntimeError("a task fails")
        return whole(rows, kind)

    monkeypatch.setattr(shardfiles, "shard_table", breaks)
    with pytest.raises(Exception, match="a task fails"):
        export.export_shards(vec, names, str(tmp_path), "r", "c", "v", rows_per_shard=2)
    assert not list(tmp_path.rglob("*.parquet")) and not (tmp_path / "manifest.json").exists()


def test_export_of_a_matrix_and_a_list_of_names(spark, tmp_path):
    matrix = np.random.default_rng(1).normal(size=(7, 3)).astype(np.float32)
    np.save(tmp_path / "m.npy", np.asfortranarray(matrix))
    (tmp_path / "names.txt").write_text("".join(f"uk.co.shop{i % 2}.h{i}\n" for i in range(7)))
    made = api.shard_export(f"file://{tmp_path}/m.npy", str(tmp_path / "names.txt"), f"file://{tmp_path}/out", "r", "c", "v", rows_per_shard=4, precision="fp32", normalize=False)
    rows = pq.read_table(tmp_path / "out/vectors").sort_by("row_id")
    assert rows.column("host_key").to_pylist() == [f"h{i}.shop{i % 2}.co.uk" for i in range(7)] and set(rows.column("domain_key").to_pylist()) == {"shop0.co.uk", "shop1.co.uk"}
    assert np.array_equal(np.array(rows.column("embedding").to_pylist(), dtype=np.float32), matrix) and made["num_shards"] == 2


def test_size_model(spark):
    assert {r["place"]: (r["n"], r["bytes"]) for r in contract.widths(spark).collect()} == {"header": (3, 0), "row_default": (11, 24), "row_sidecar": (4, 8)}
    assert contract.fields(spark, "header").count() == 3 and contract.fields(spark).count() == 18
    with pytest.raises(ValueError, match="place"):
        contract.fields(spark, "footer")
    one = contract.size_table(spark, 262_351_908, [128], ["fp32"]).first()
    assert 124 < one["vector_gib"] < 126 and one["metadata_bytes"] == 262_351_908 * 48
    assert contract.size_table(spark, 1000).count() == 9
    assert len(contract.format_table(contract.size_table(spark, 1000)).splitlines()) == 10
    for nodes, dim, precision in ((1, 8, "bf16"), (1, 0, "fp32"), (0, 8, "fp32")):
        with pytest.raises(ValueError):
            contract.size_table(spark, nodes, [dim], [precision])


def test_ranking(spark):
    emb = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, embedding array<float>")
    top = vectors.eval_mrr(spark.createDataFrame([(0, 9, 9)], "eid long, src long, dst long"), emb, 10, 50).first()
    assert top["mrr"] == 1.0 == top["hits_1"]
    low = vectors.ranked(spark.createDataFrame([(0, 9, 0)], "eid long, src long, dst long"), emb, 10, 50).first()["rank"]
    assert low > 30
    near = neighbors.cosine_topk(emb, [3], 2).orderBy("rank").collect()
    assert [r["neighbor_id"] for r in near] == [4, 5] or [r["neighbor_id"] for r in near] == [4, 2]


def test_cells_are_skipped_and_nothing_is_missed(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 8))
    x = centre[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 0.05
    x[:700] = x[0]  # copies, more than a block
    x[700:703] = 0
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)] + [(5000, None)]
    emb = spark.createDataFrame(rows, "id long, embedding array<float>")
    found, told = neighbors.search(emb, emb.where("id % 50 = 0"), 4, block=128)
    unit = np.array([np.array(v, dtype=np.float32) / np.float32(max(np.linalg.norm(np.array(v, dtype=np.float64)), 1e-30)) for _, v in rows[:-1]]).astype(np.float64)
    got = {(r["query_id"], r["rank"]): (r["neighbor_id"], r["cosine"]) for r in found.collect()}
    for q in range(0, 3000, 50):
        score = np.round(unit @ unit[q], 6)
        for rank in range(1, 5):
            n, c = got.pop((q, rank))
            assert n != q and abs(score[n] - c) < 2e-6
            assert sorted(np.delete(score, q))[-rank] == pytest.approx(c, abs=2e-6)
    assert not got
    n = told.first()
    assert (n["queries"], n["vectors"]) == (60, 3000) and n["compared"] < 0.4 * 60 * 2999
    none = spark.createDataFrame([], "id long, embedding array<float>")
    assert neighbors.cosine_topk(none, none, 3).count() == 0 and neighbors.cosine_topk(emb, none, 3).count() == 0


def test_ranks_with_missing_vectors(spark):
    rng = np.random.default_rng(2)
    table = {i: rng.normal(size=6).astype(np.float32) for i in range(50) if i % 7}
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in table.items()], "id long, embedding array<float>")
    edges = [(100 + i, i % 50, (i * 3 + 1) % 50) for i in range(80)]
    want = {}
    for eid, a, b in edges:
        if a in table and b in table:
            dot = lambda x: round(float(table[a].astype(float) @ table[x].astype(float)), 6)  # noqa: B023, E731
            drawn = [((eid * 9 + k + 42) * 0x9E3779B97F4A7C15 % 2**64) % 50 for k in range(9)]
            want[eid] = 1 + sum(x in table and dot(x) > dot(b) for x in drawn)
    for batch in (7, 512):
        out = vectors.ranked(spark.createDataFrame(edges, "eid long, src long, dst long"), emb, 50, 9, 42, batch=batch)
        assert {r["eid"]: r["rank"] for r in out.collect()} == want


def test_run_directory(spark, tmp_path):
    run = store.RunDirectory(str(tmp_path), "x")
    run.log_metrics(1, loss=np.float32(0.5))
    run.log_metrics(2, loss=0.25, rows=np.arange(2))
    run.mark_last()
    assert [r["loss"] for r in run.read_metrics(spark).collect()] == [0.5, 0.25]
    assert store.read_document(spark, f"file://{tmp_path}/LAST") == {"run": run.name}
