"""Line deduplication, vector codes and the filter audit against SQL and brute force."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostweave.llm import audit, catalog, codebooks, lines
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
LONG = "This line is longer than forty characters, É included."
DOCS = [
    (0, f"{LONG}\nown zero", "a"), (1, f"  {LONG.upper()}\t\n{LONG}", "a"), (2, LONG, None), (3, f"\n\n{LONG}\n", "a"), (4, f"{LONG}\nx\n{LONG.lower()}", "b"),
    (5, f"first\n{LONG}\nlast\n{LONG}", "b"), (6, None, "b"), (7, "", "b"), (8, "short\nshort", ""), (9, "short\nshort", "b"), (9, "short\nshort", "b"), (None, f"{LONG}\nnull id", "c"),
    (10, "\n".join(f"Number {i} of a text that has very many lines." for i in range(200)), "a"), (11, "Number 3 of a text that has very many lines.\n" * 130, "a"), (12, "Number 3 of a text that has very many lines.\nz", "a"),
    (13, "number 3 of a TEXT that has very many lines.", "a"), (14, "Number 3 of a text that has very many lines. ", "a"), (15, "y\x0b\nNumber 3 of a text that has very many lines.\n\n", "c"), (16, "word " * 300, "c"), (17, "ABC # " * 250, None),
]


def frame(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"n_lines": F.lit("clash"), "h1": F.lit(1), "mask": F.lit(2), "pos": F.lit(3)})


@pytest.mark.parametrize("name", ["op11_codes", "op12_lines", "op13_audit"])
def test_query_equals_its_sql(spark, name):
    assert compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF) == ""


def plain_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
    held = collections.defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    last = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text, *_ in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if key(x) not in last or last[key(x)] == i]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("hot", [1 / 256, 1 / 2, 1e-4])
def test_lines_equal_plain_ones(spark, monkeypatch, hot):
    monkeypatch.setattr(lines, "HOT", hot)
    rows = DOCS + [(i, "\n".join(f"{LONG} {(i * k) % 7} {k}" for k in range(i % 9)), "r") for i in range(100, 160)]
    docs = frame(spark, rows)
    out = lines.deduplicated(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == plain_lines(rows)
    maps = lines.keep_bitmaps(docs).collect()
    words = {r["doc_id"]: [(w["word"], w["bits"]) for w in r["keep"]] for r in maps}
    assert all(bits != -1 for w in words.values() for _, bits in w) and 6 not in words and [w for w, _ in words[11]] == [0, 1, 2]


def test_line_ranges_are_exchanged_once(spark):
    rows = lines.line_hashes(frame(spark))
    plan = lines.dropped_lines(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning(h1" not in plan.split("Window")[1].split("rangepartitioning")[0]
    assert "Python" not in plan and "Arrow" not in plan


def plain_codes(rows, entries, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = np.floor(np.array([r[1] for r in kept], dtype=np.float64) * 1024).astype(np.int64)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(kept[i][1])))[:entries]
    parts = np.split(whole, 4, axis=1)
    books = [p[order].copy() for p in parts]
    near = lambda p, c: ((p[:, None, :] - c) ** 2).sum(axis=2)
    for _ in range(rounds):
        for p, c in zip(parts, books, strict=True):
            at = near(p, c).argmin(axis=1)
            for e in set(at.tolist()):
                c[e] = p[at == e].sum(axis=0) // (at == e).sum()
    d = [near(p, c) for p, c in zip(parts, books, strict=True)]
    codes = np.stack([x.argmin(axis=1) for x in d], axis=1)
    error = sum(x.min(axis=1) for x in d)
    by = collections.Counter()
    for r, e in zip(kept, error.tolist(), strict=True):
        by[r[2]] += e
    told = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return collections.Counter((r[0], "".join(f"{c:02x}" for c in code), int(e), by[r[2]], told) for r, code, e in zip(kept, codes.tolist(), error.tolist(), strict=True))


def vectors(spark, rows, path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("parts", F.lit("clash")).write.parquet(f"{path}/embeddings.parquet")
    return [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def codes(spark, path):
    return collections.Counter(tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in codebooks.op11_codes(spark, str(path)).collect())


@pytest.mark.parametrize(("n", "scale", "step"), [(1500, 1.0, None), (1500, 1.0, 1 / 256), (90, 3000.0, None), (700, 1.0, 1 / 4)])
def test_codes_equal_plain_ones(spark, tmp_path, n, scale, step):
    rng = np.random.default_rng(n)
    centre = rng.normal(size=(12, 16))
    x = (centre[rng.integers(0, 12, n)] + rng.normal(size=(n, 16)) * 0.2) * scale
    x = (np.round(x / step) * step if step else x).astype(np.float32)  # coarse steps make ties
    rows = [(int(i) if i % 50 else None, row.tolist(), int(i) % 3 if i % 7 else None) for i, row in enumerate(x)]
    rows += [(5, rows[5][1], 1), (6, rows[7][1], None), (7, None, 1), (8, [float("nan")] * 16, 1), (9, [float("inf")] + [0.0] * 15, 1), (10, [None] + [0.0] * 15, 1)]
    rows = vectors(spark, rows, tmp_path)
    want = plain_codes(rows, 256)
    got = codes(spark, tmp_path)
    assert sum(want.values()) == n + 2 and got == want


def test_few_and_no_vectors(spark, tmp_path):
    for at, rows in enumerate(([], [(1, None, 1)], [(3, [0.5] * 8, None)], [(3, [0.5] * 8, None), (1, [-0.5] * 8, 2)])):
        made = vectors(spark, rows, tmp_path / str(at))
        assert codes(spark, tmp_path / str(at)) == (plain_codes(made, 256) if at > 1 else collections.Counter())
    vectors(spark, [(1, [1.0, 2.0, 3.0], 1), (2, [], 1), (3, [0.25] * 5, 1)], tmp_path / "uneven")
    assert sum(codes(spark, tmp_path / "uneven").values()) == 3
    vectors(spark, [(1, [1e30] * 4, 1)], tmp_path / "huge")
    with pytest.raises(ValueError, match="too large"):
        codes(spark, tmp_path / "huge")


def test_bounds_spare_most_groups(spark):
    state, books, _ = codebooks.train(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    groups = sum(len(b.members) for b in books)
    assert state.agg(F.avg("scanned")).first()[0] < 0.6 * groups


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    masks = collections.defaultdict(list)
    for i, text, source in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and i > first[text]}
        masks[source or ""].append((fails, i))
    out, shapley = {}, collections.Counter()
    for part, own in masks.items():
        for order in itertools.permutations("ABCDE"):
            for s, f in enumerate(order, 1):
                seen = [(fails, i, any(fails[x] for x in order[: s - 1])) for fails, i in own]
                here = [i for fails, i, before in seen if fails[f] and not before]
                out[part, "".join(order), s] = [sum(not before and not fails[f] for fails, _, before in seen), len(here), sum(before and fails[f] for fails, _, before in seen), sum(sum(fails.values()) == 1 and fails[f] for fails, _ in own), sum(i in good for i in here), sum(i in toxic for i in here)]
                shapley[part, f] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("bits", [64, 1])
def test_audit_equals_plain_one(spark, monkeypatch, bits):
    monkeypatch.setattr(audit, "HEAVY", 8)
    rows = DOCS + [(i, "same text " * (i % 3 + 1), "a" if i % 2 else "b") for i in range(200, 240)] + [(300 + i, f"x{i % 5}y" * 30, "d") for i in range(20)]
    labels = [(i, i % 2, (i or 0) % 3 == 0) for i in range(0, 320, 2)] + [(200, None, None), (202, 1, None), (None, 1, 1)]
    told = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.audit(frame(spark, rows), told, bits).collect()}
    assert got == plain_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(frame(spark, []), none).count() == 0
    assert lines.deduplicated(frame(spark, [])).count() == 0
    assert audit.audit(frame(spark), none).count() == 600 * 4
