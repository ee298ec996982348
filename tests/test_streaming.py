import random

from hostweave.operators import releases
from hostweave.streaming import releases as stream


def test_lifecycles_of_arriving_releases(spark, tmp_path):
    """In any order, with a release that comes twice and one that comes in two files."""
    r = random.Random(4)
    hosts = [f"h{i}.com" for i in range(40)]
    held = [{h: k for k, h in enumerate(sorted(r.sample(hosts, 25)))} for _ in range(4)]
    frames = [(f"rel-{i}", spark.createDataFrame([(h, k) for h, k in x.items()], "host_key string, local_node_id long")) for i, x in enumerate(held)]
    want = {row["host_key"]: row for row in releases.release_index(frames).collect()}
    for n, (seq, half) in enumerate([(2, None), (0, None), (3, 0), (1, None), (3, 1), (0, None)]):
        rows = [(h, seq, f"rel-{seq}", k) for h, k in held[seq].items() if half is None or k % 2 == half]
        spark.createDataFrame(rows, stream.ARRIVAL).coalesce(1).write.parquet(f"{tmp_path}/in{n}")
        stream.stored_updates(stream.sightings(stream.release_stream(spark, f"{tmp_path}/in*")), f"{tmp_path}/updates", f"{tmp_path}/checkpoint")
    got = {row["host_key"]: row for row in stream.as_of(spark.read.parquet(f"{tmp_path}/updates"), 3).collect()}
    assert got == want and {row["state"] for row in got.values()} >= {"active", "missing", "reappeared"}
    early = {row["host_key"]: row["state"] for row in stream.as_of(spark.read.parquet(f"{tmp_path}/updates"), 4).collect()}
    assert set(early.values()) == {"missing"}
