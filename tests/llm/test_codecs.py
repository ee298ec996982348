"""BPE, media, sharding, URLs and packing against references, round trips and brute force."""

import collections
import hashlib
import random
import time
import zlib
from array import array

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from hostweave.llm import bpe, media, packing, shards, urls

ODD = ["", None, " ", "a  b\n \nc ", "word " * 4000, "x" * 3000, "日本語 テスト😀‍👩 ß", "it's we'll  12,345.67\t\r\n", "é" * 5, "<|endoftext|>", "\u00a0 a\u2003 b", "same", "same"]


def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").withColumn("ids", F.lit("clash"))


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_equals_the_library(spark, name):
    path = public_tokenizers.path(name)
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()] + ODD
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    r = random.Random(3)
    texts += ["".join(r.choice(["a", "the", "é", "日", " ", "\n", "x", "1", "!", "😀", "ing", "  ", "'s", "\t"]) for _ in range(r.randint(1, 60))) for _ in range(400)]
    for text in texts:
        ids = own.encode(text or "")
        assert list(array("I", ids)) == library.encode_ordinary(text or "")
        assert "".join(own.decode(ids, 3)) == (text or "")
    short = bpe.Transducer(ranks, window=24)
    for _ in range(200):
        piece = "".join(r.choice(["ab", "é", "日", "zz", "ing", "e", "tion", "\n"]) for _ in range(r.randint(1, 80))).encode()
        assert b"".join(short.tokens[t] for t in short.encode(piece)) == piece
        assert short.encode(piece) == library._core_bpe.encode_single_piece(piece)
    full = bpe.tokenize(odd(spark), path, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    short_form = bpe.tokenize(odd(spark), path, public_tokenizers.PATTERN, digests=True).orderBy("doc_id").collect()
    for r1, r2, text in zip(full, short_form, ODD, strict=True):
        assert r1["decoded"] == (text or "") and r1["n_tokens"] == r2["n_tokens"] == len(r1["ids"])
        assert r2["ids_sha256"] == hashlib.sha256(np.array(r1["ids"], dtype="<u4").tobytes()).hexdigest()
        assert r2["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_decoder_mends_nothing():
    ranks = {bytes([i]): i for i in range(256)}
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert "".join(own.decode(array("I", [0xF0, 0x9F, 0x98, 0x80, 0xC3]).tobytes(), 1)) == "😀\ufffd"


def test_media_round_trip(spark):
    rows = media.media_columns(odd(spark)).orderBy("doc_id").collect()
    digests = media.media_columns(odd(spark), digests=True).orderBy("doc_id").collect()
    for r, d, text in zip(rows, digests, ODD, strict=True):
        data = (text or "").encode()
        payload = b"".join(media.read_wav(bytes(r["media"]), 100))
        assert payload == data + bytes(len(payload) - len(data)) and len(payload) % 64 == 0 < len(payload) and len(payload) - len(data) <= 64
        assert (d["n_bytes"], d["payload_bytes"], d["media_bytes"]) == (len(data), len(payload), len(r["media"]))
        assert d["payload_sha256"] == hashlib.sha256(payload).hexdigest() and d["media_sha256"] == hashlib.sha256(r["media"]).hexdigest()
        assert d["tail_crc32"] == zlib.crc32(payload[-64:]) and len(r["peak_codes"]) == len(r["peak_times"]) == d["n_pairs"]
    assert rows[-1]["media"] == rows[-2]["media"] and digests[-1]["feature"] == digests[-2]["feature"]


def plain_peak_pairs(payload):
    """The features, frame by frame and peak by peak."""
    x = [np.float32((b - 128) / 128) for b in payload]
    n = max(0, -(-(len(x) - media.FRAME) // media.HOP)) + 1
    x += [np.float32(0)] * ((n - 1) * media.HOP + media.FRAME - len(x))
    frames = [np.abs(np.fft.rfft(np.array(x[k * media.HOP : k * media.HOP + media.FRAME], dtype=np.float32) * media.WINDOW)) for k in range(n)]
    best = [[max(range(a, b), key=lambda k: (f[k], -k)) for a, b in media.BANDS] for f in frames]
    peaks = []
    for t, f in enumerate(frames):
        own = []
        for band, k in enumerate(best[t]):
            before = frames[t - 1][best[t - 1][band]] if t else -1
            after = frames[t + 1][best[t + 1][band]] if t + 1 < n else -1
            if f[k] > 1e-6 and f[k] >= before and f[k] > after:
                own.append((-f[k], band, k))
        peaks += sorted((t, k) for _, _, k in sorted(own)[: media.PEAKS])
    pairs = []
    for i, (t, k) in enumerate(peaks):
        for u, m in peaks[i + 1 : i + 1 + media.FAN]:
            if 0 < u - t <= media.REACH:
                pairs.append((k << 12 | m << 4 | u - t, t))
    return pairs


def test_peak_pairs_equal_plain_ones(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(12).collect()] + ["", "a", "x" * 300, "ab" * 130, "é" * 64]
    for text in texts:
        payload = media.pad(text.encode()[:20_000])
        codes, times = media.peak_pairs(media.read_wav(media.write_wav(payload)))
        assert list(zip(codes.tolist(), times.tolist(), strict=True)) == plain_peak_pairs(payload)
    rows = media.media_columns(odd(spark), digests=True).collect()
    assert all(list(zip(r["peak_codes"], r["peak_times"], strict=True)) == plain_peak_pairs(media.pad((ODD[r["doc_id"]] or "").encode())) for r in rows)


def test_spectra_do_not_depend_on_blocks():
    rng = np.random.default_rng(0)
    data = bytes((128 + 60 * np.sin(np.arange(20000) * rng.random(20000).cumsum() / 9000) + rng.integers(0, 9, 20000)).astype(np.uint8))
    wav = media.write_wav(data)
    whole = media.peak_pairs(media.read_wav(wav))
    assert len(whole[0]) > 50 and (np.diff(whole[1]) >= 0).all()
    for block in (100, 999, 5000):
        assert all((a == b).all() for a, b in zip(whole, media.peak_pairs(media.read_wav(wav, block)), strict=True))
    shifted = set(zip(*(x.tolist() for x in media.peak_pairs(media.read_wav(media.write_wav(data[128 * 20 :])))), strict=True))
    own = {(c, t - 20) for c, t in zip(whole[0].tolist(), whole[1].tolist(), strict=True)}
    assert len(own & shifted) > 0.8 * len(shifted)


@pytest.mark.parametrize(("n", "per_bucket"), [(0, 16), (7, 16), (1000, 16), (1003, 4096)])
def test_shards_are_exact(spark, n, per_bucket):
    docs = spark.range(n).select((F.col("id") % max(1, n - 2)).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same é")).when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("text"), F.lit(1).alias("shard"))
    got = shards.shuffled(docs, 40, rows_per_bucket=per_bucket).collect()
    assert len(got) == n
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert sorted(len(by[s]) for s in range(40)) == sorted(n // 40 + (s < n % 40) for s in range(40))
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert all((r["size"], r["text_crc32"]) in {(16, 0)} or r["size"] > 16 for r in got)


def test_draws_follow_the_distribution(spark):
    u = shards._uniform(F.lit(5), F.col("id"))
    draw = spark.range(3000).select(shards.hypergeometric(F.lit(50), F.lit(12), F.lit(20), u).alias("x"), shards.hypergeometric(F.lit(10**10), F.lit(10**9), F.lit(10**6), u).alias("y"), shards.hypergeometric(F.lit(9), F.lit(9), F.lit(4), u).alias("z")).toPandas()
    want = np.random.default_rng(0).hypergeometric(12, 38, 20, 200_000)
    for k in range(2, 9):
        assert abs((draw.x == k).mean() - (want == k).mean()) < 0.03
    assert abs(draw.y.mean() - 1e5) < 30 and 270 < draw.y.std() < 330 and set(draw.z) == {4}


def test_matrix_keeps_both_sums(spark):
    sizes = spark.createDataFrame([(0, 90), (1, 3), (2, 0), (3, 7)], "bucket long, n long")
    got = {r["bucket"]: r["counts"] for r in shards.communication_matrix(sizes, 8, 100, 3, 1).collect()}
    assert [sum(got[b]) for b in range(8)] == [90, 3, 0, 7, 0, 0, 0, 0]
    assert [sum(got[b][s] for b in range(8)) for s in range(3)] == [34, 33, 33]


def test_matrix_in_several_rounds(spark):
    sizes = spark.createDataFrame([(b, b * b % 13) for b in range(32)], "bucket long, n long")
    n = sum(b * b % 13 for b in range(32))
    one, more = ({r["bucket"]: r["counts"] for r in shards.communication_matrix(sizes, 32, n, 5, 9, levels=k).collect()} for k in (12, 2))
    assert one == more and [sum(one[b]) for b in range(32)] == [b * b % 13 for b in range(32)]


def test_shuffle_of_rows_alike_is_uniform(spark):
    n = 6000
    docs = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("t")).alias("text"))
    got = shards.shuffled(docs, 10, rows_per_bucket=100).collect()
    again = shards.shuffled(docs, 10, rows_per_bucket=100).collect()
    assert sorted(got) == sorted(again) and len(got) == n
    hot = collections.Counter(r["shard"] for r in got if r["size"] == 19)
    assert sum(hot.values()) == 2000 and all(abs(hot[s] - 200) < 5 * 11.5 for s in range(10))  # hypergeometric: deviation 11.5
    early = sum(r["slot"] < 300 for r in got if r["size"] == 19)
    assert abs(early - 1000) < 5 * 18.3
    neighbours = collections.defaultdict(list)
    for r in got:
        if r["size"] != 19:
            neighbours[r["shard"]].append((r["slot"], r["doc_id"]))
    for rows in neighbours.values():
        ids = np.array([i for _, i in sorted(rows)], dtype=float)
        assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 5 / len(ids) ** 0.5


URLS = [
    ("HTTP://A.Example.NET/en/x?q", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://example.net/e", "example.net", "/e", "net/", "block"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("x://b.example.com/de/://c?d#e", "b.example.com", "/de/://c", "example.com/de/", "block"),
    ("http://w.org/fr/#f", "w.org", "/fr/", "org/fr/", "allow"),
    ("http://w.org?fr/", "w.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://É.net/a\nb", "É.net", "/a\nb", "net/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(0, URLS[0][0])], "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = urls.judged(pages, labels).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]][1:]
    assert urls.judged(pages.limit(0), labels).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, f"https://{rng.choice(['bad', 'good', 'blog'])}.site{rng.randint(0, 3)}.com/{rng.choice(['ads', 'news'])}/{i}") for i in range(400)]
    marks = [(i, int(not ("bad" in u and "ads" in u)), int("site3" in u and "news" in u and i % 10 != 0)) for i, u in rows]
    pages, labels = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in urls.judged(pages, labels, rules=()).collect()}
    block = {i: q == 0 or t == 1 for i, q, t in marks}
    sets = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", urls.tokens(F.col("url")).alias("t")).collect()}
    import itertools

    seen = collections.Counter(c for s in sets.values() for k in range(1, len(s) + 1) for c in itertools.combinations(sorted(s), k))
    hit = collections.Counter(c for i, s in sets.items() if block[i] for k in range(1, len(s) + 1) for c in itertools.combinations(sorted(s), k))
    rules = {c for c in seen if hit[c] >= 10 and hit[c] / seen[c] >= 0.6 and hit[c] / seen[c] > sum(block.values()) / 400}
    assert rules and all((got[i]["verdict"] == "block") == any(set(c) <= s for c in rules) for i, s in sets.items())


def test_mined_rules_with_repeats_ties_and_long_urls(spark):
    rows = [(None if i % 9 == 0 else i % 40, f"https://{'bad' if i % 2 else 'good'}.x.com/{'a' if i % 4 < 2 else 'b'}/{i % 40}") for i in range(120)] + [(500, "https://bad.y.org/" + "z" * 200_000), (501, "https://bad.y.org/"), (501, "https://bad.y.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"tokens": F.lit("clash"), "block": F.lit(1), "r": F.lit(2)})
    labels = spark.createDataFrame([(i, 1 - i % 2, None) for i in range(40)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = [(r["page_id"], r["verdict"], r["mined"]) for r in urls.judged(pages, labels, rules=()).collect()]
    assert len(got) == len(rows) and sum(i is None for i, _, _ in got) == 14
    assert all((v == "block") == (m is not None) for _, v, m in got)
    assert {m for i, _, m in got if i in (500, 501)} == {"h:bad"} and sum(i == 501 for i, _, _ in got) == 2
    assert {v for i, v, _ in got if i is not None and i < 40 and i % 2 == 0} == {"allow"} and {v for i, v, _ in got if i is not None and i < 40 and i % 2} == {"block"}
    assert urls.judged(pages.limit(0), labels.limit(0)).count() == 0


def test_packing_is_best_fit_under_constraints(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "x" * int(rng.integers(0, 60)) + f"{i % 23}", f"s{min(i % 7, 3)}" if i % 11 else None) for i in range(600)] + [(700, None, "s1"), (701, "y" * 345, "s1"), (702, "", None), (702, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bin", F.lit(0))
    got = packing.packed(docs, 100, 2, group_bins=1000).collect()
    texts, source = {}, {}
    for i, t, s in rows:
        texts[i], source[i] = t or "", s
    bins = collections.defaultdict(list)
    parts = collections.defaultdict(list)
    for r in got:
        bins[r["bin"]].append(r)
        parts[r["doc_id"]].append((r["start"], r["length"]))
    for own in bins.values():
        own.sort(key=lambda r: (r["offset"], r["length"]))
        assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(own, own[1:])) and own[-1]["offset"] + own[-1]["length"] <= 100
        whole = [texts[r["doc_id"]] for r in own]
        assert len(set(whole)) == len(whole)
        held = collections.Counter(source[r["doc_id"]] for r in own if source[r["doc_id"]])
        assert max(held.values(), default=0) <= 2
    assert parts[701] and sum(n for _, n in parts[701]) == 345 and sorted(parts[701])[:3] == [(0, 100), (100, 100), (200, 100)]
    assert len(parts[702]) == 2 and sum(len(p) for i, p in parts.items() if i < 700) == 600


def test_each_choice_is_the_tightest_fit():
    rng = random.Random(0)
    sizes = sorted((rng.randint(0, 60) for _ in range(200)), reverse=True)
    sources, clusters = [rng.choice("abc") for _ in sizes], [rng.randint(0, 90) for _ in sizes]
    bins = packing.Bins(100, 2)
    plain = []  # [room, clusters, sources]
    for n, s, c in zip(sizes, sources, clusters, strict=True):
        b, offset = bins.place(n, ord(s) - 97, c)
        fits = [i for i, x in enumerate(plain) if x[0] >= n and c not in x[1] and x[2].count(s) < 2]
        if fits:
            best = min(plain[i][0] for i in fits)
            assert b < len(plain) and plain[b][0] == best and b in fits
        else:
            assert b == len(plain)
            plain.append([100, [], []])
        assert offset == 100 - plain[b][0]
        plain[b][0] -= n
        plain[b][1].append(c)
        plain[b][2].append(s)


@pytest.mark.parametrize("capacity", [100, 300_000])
def test_choices_with_hot_clusters_and_sources(capacity):
    rng = random.Random(1)
    docs = sorted(((rng.choice([0, 1, 5, 5, 5, rng.randint(0, capacity // 3)]), rng.choice([None, 0, 0, 0, 1, 2]), rng.choice([None, 0, 0, 1, 1, rng.randint(2, 40)])) for _ in range(1500)), key=lambda x: -x[0])
    bins, plain = packing.Bins(capacity, 2), []
    for size, s, c in docs:
        fits = [(x[0], i) for i, x in enumerate(plain) if x[0] >= size and (c is None or c not in x[1]) and (s is None or x[2].count(s) < 2)]
        b, offset = bins.place(size, s, c)
        assert b == (min(fits)[1] if fits else len(plain))
        if not fits:
            plain.append([capacity, [], []])
        assert offset == capacity - plain[b][0]
        plain[b][0] -= size
        plain[b][1].append(c)
        plain[b][2].append(s)


def test_thousands_of_equal_texts_take_no_scan_each(spark):
    started = time.monotonic()
    n = 30_000
    found = packing.pack_group([7] * n, [f"s{i % 3}" for i in range(n)], [1] * n, 1000, 4)
    assert len({p[0][0] for p in found}) == n
    found = packing.pack_group([7] * n, ["hot"] * n, list(range(n)), 1000, 4)
    assert len({p[0][0] for p in found}) == n // 4
    assert time.monotonic() - started < 20  # a scan of all bins for each takes minutes


def test_packing_by_given_clusters(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "s", i % 2 if i < 4 else None) for i in range(8)], "doc_id long, text string, source string, near long")
    got = {r["doc_id"]: r["bin"] for r in packing.packed(docs, 1000, 9, cluster_col="near").collect()}
    assert got[0] != got[2] and got[1] != got[3] and len(set(got.values())) == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.packed(none).count() == 0 == media.media_columns(none).count()
    assert bpe.tokenize(none, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
