import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hostweave.llm import simhash as s


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, distance):
    """Node to least reachable node, comparing all pairs."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


ROWS = [(1, "A b c d e f"), (2, "a B C d e f"), (3, None), (4, ""), (5, " \t\n"), (6, "one"), (7, "Ünï Çødé Ünï"), (7, "Ünï Çødé Ünï"), (None, "one"), (8, "w%d " * 20000 % tuple(range(20000)))]


def test_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = s.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    texts = {}
    for i, t in ROWS:
        texts.setdefault(i, t)
    for r in got:
        if r["doc_id"] is not None:
            assert r["fp"] & (2**64 - 1) == brute_fingerprint(texts[r["doc_id"]])
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, None: 6, 8: 8}
    assert s.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("distance", "tables"), [(4, 3), (4, 5), (10, 6)])
def test_links_equal_brute_force(spark, distance, tables):
    rng = np.random.default_rng(distance)
    some = [int(x) for x in rng.integers(-(2**63), 2**63, 60)]
    hot = some[0]
    for _ in range(300):  # a large group around one fingerprint, and chains away from it
        x = hot if rng.random() < 0.7 else some[int(rng.integers(len(some)))]
        for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
            x ^= 1 << int(b) if b < 63 else -(1 << 63)
        some.append(x)
    nodes = sorted(set(some))
    fps = spark.createDataFrame([(x,) for x in nodes], "fp long")
    links = s.find_links(fps, distance, tables)
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= distance for r in links.collect())
    roots = {r["node"]: r["root"] for r in s.components(links).collect()}
    assert {n: roots.get(n, n) for n in nodes} == brute_components(nodes, distance)


def test_segments_and_balls():
    for distance, tables in ((4, 3), (10, 6), (1, 2), (7, 2)):
        parts = s.segments(distance, tables)
        assert sum(b for _, b, _ in parts) == 64 and sum(r + 1 for _, _, r in parts) > distance
    assert len(s.ball(10, 2)) == 1 + 10 + 45 == len(set(s.ball(10, 2)))
    for bad in ((2, 4), (3, 1)):
        with pytest.raises(ValueError):
            s.segments(*bad)


def test_long_chain_settles(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["root"] for r in s.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_deduplicated_keeps_one_of_each_group(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 400)) for _ in range(6)]
    near = base[0].split()
    near[200] = "changed"
    rows = [(10 + i, t) for i, t in enumerate(base)] + [(3, base[1]), (4, " ".join(near)), (4, " ".join(near)), (None, base[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_extra", F.lit(1))
    out = s.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 4, 12, 13, 14, 15]


def test_deduplicated_whatever_columns_are_called(spark):
    rows = [(1, "one two three four five six", 5), (1, "one two three four five six", 5), (2, "one two three four five six", 6), (None, None, 7), (3, None, 8), (4, "long " * 30_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hw_id long").withColumns({"first": F.lit("a"), "node": F.lit("b"), "root": F.lit("c"), "_hw_hash": F.lit("d"), "a.b": F.lit("e")})
    out = s.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["_hw_id"]) for r in out.collect()) == [(1, 5), (3, 8), (4, 9)]
    assert s.deduplicated(docs.limit(0)).count() == 0


def brute_pairs(texts, least):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    return {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9}


def test_deduplicated_equals_brute_force_around_the_limit(spark):
    rng = np.random.default_rng(8)
    texts = []
    for k in range(60):  # pairs at 0.6 to 0.95, by changed words far from each other
        words = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
        other = list(words)
        for at in range(3, 3 + 6 * (k % 12 + 1), 6):
            other[at] = f"x{k}-{at}"
        texts += [" ".join(words), " ".join(other)]
    pairs = brute_pairs(texts, 0.8)
    assert 25 <= len(pairs) <= 50 and len(brute_pairs(texts, 0.6)) > len(pairs)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in s.deduplicated(docs).collect()}
    assert set(range(len(texts))) - kept == {j for _, j in pairs}


@pytest.mark.parametrize(("chunk", "most"), [(7, 1 << 20), (4096, 1 << 20), (4096, 20)])
def test_large_groups_link_as_all_pairs_do(spark, chunk, most):
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in range(120)]
    texts = []
    for k in range(40):
        words = list(base)
        for at in rng.choice(120, k % 4, replace=False):
            words[at] = f"x{k}-{at}"
        texts.append(" ".join(words))
    pairs = brute_pairs(texts, 0.8)
    root = list(range(40))
    for _ in root:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    keys = spark.createDataFrame([(i, [1, 2], 1 + (i == 5) * 100) for i in range(40)], "node long, bands array<long>, size long")
    groups = s.candidates(keys, chunk, most)
    if most == 20:  # the text that is larger than a part is one
        parts = groups.groupBy("group").agg(F.count("*").alias("n"), F.max((F.col("node") == 5).cast("int")).alias("large")).collect()
        assert max(r["n"] for r in parts) <= 40 and any(r["large"] for r in parts) and max(r["n"] for r in parts if r["large"]) <= 21
    assert groups.groupBy("group").count().agg(F.max("count")).first()[0] <= (40 if chunk > 40 else 2 * chunk)
    members = groups.join(spark.createDataFrame(list(enumerate(texts)), "node long, text string"), "node")
    found = {r["node"]: r["root"] for r in s.components(s.verified(members, 5, 42, 0.8)).collect()}
    assert [found.get(i, i) for i in range(40)] == root


def test_linked_fingerprints_are_candidates(spark, monkeypatch):
    """Near copies are found by their fingerprints where no min-hash key brings them together."""
    seen = []
    real = s.find_links
    monkeypatch.setattr(s, "find_links", lambda *a, **k: (seen.append(1), real(*a, **k))[1])
    apart = iter(range(1 << 40))
    monkeypatch.setattr(s, "band_keys", lambda found, bands, size, seed=42: np.array([next(apart)], dtype=np.uint64))
    long = " ".join(f"word{i * 7919 % 1009}" for i in range(3000))
    rows = [(1, long), (2, long + " end"), (3, " ".join(f"other{i * 31 % 997}" for i in range(900))), (4, None), (5, "")]
    out = s.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4] and seen
