"""Vector codes by product quantisation; codebooks by Lloyd's rounds with Yinyang bounds.

Components are integers, ``floor(1024 * x)``; vectors are cut into equal parts, each with
a codebook of its own. A round assigns every part to its nearest entry and moves each
entry to the floored mean of its parts.

Yinyang: the entries of a codebook are put into groups once. Each part of a vector keeps
its entry and, for each group, one lower bound of its distance to the group's other
entries. When entries move, a bound falls by the group's largest move. Only groups whose
bound doesn't exceed the exact distance to the entry in hand are scanned. Bounds are
floating point, always rounded down, and groups whose bound equals the distance are
scanned too; which entry is nearest, and the tie to the lower index, is decided between
exact integer distances.

A row is a vector with its entries and bounds. Each round reads that table and writes it
anew, the table before is then removed, so a lost executor's work is done again from what
is stored, and no more than two rounds' tables are there at once. What comes to the
driver, and is sent to tasks, are codebooks: ``parts * entries`` rows.

Defined results: rows whose vector is null, or has a null or a non-finite component, go;
vectors shorter than the longest are taken as ending in zeros, also up to a multiple of
the parts; repeated rows and ids are coded one by one, in the first codebook in order of
id (nulls last) and then of vector; with fewer vectors than entries there are so many
entries; null labels are one label; an empty table gives an empty result; extra columns
are not read; components beyond what exact distances in 64 bits allow are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut, met
from hostweave.sources.scratch import new_path, remove

SCALE, PARTS, ENTRIES, ROUNDS, GROUPS = 1024, 4, 256, 4, 16
STATE = "vec_id {id}, label {label}, parts binary, entry binary, lower binary, scanned int"


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries: in doubles while these hold every sum, else in integers."""
    reach = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if points.shape[1] * (2 * reach) ** 2 < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (p * p).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (p @ e.T)


def groups(entries: np.ndarray, wanted: int, rounds: int = 5) -> list[np.ndarray]:
    """The places of a codebook's entries, clustered by a few plain rounds; no group is empty."""
    n = max(1, min(wanted, len(entries)))
    centres = entries[np.linspace(0, len(entries) - 1, n).astype(int)].astype(np.float64)
    for _ in range(rounds):
        at = ((entries[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([entries[at == g].mean(axis=0) if (at == g).any() else centres[g] for g in range(n)])
    return [np.flatnonzero(at == g) for g in range(n) if (at == g).any()]


def rounded_down(squares: np.ndarray) -> np.ndarray:
    """Square roots as half floats that are never above them."""
    return np.maximum(np.nextafter(np.minimum(np.sqrt(squares.astype(np.float64)), 60000.0).astype(np.float16), np.float16(0)), np.float16(0))


class Codebook:
    """One part's entries, their groups, and how far each group has moved."""

    def __init__(self, entries: np.ndarray, members: list[np.ndarray], moved: np.ndarray) -> None:
        self.entries, self.members, self.moved = entries, members, moved
        self.group = np.zeros(len(entries), dtype=np.int64)
        for g, some in enumerate(members):
            self.group[some] = g

    @classmethod
    def first(cls, entries: np.ndarray, wanted: int) -> Codebook:
        members = groups(entries, wanted)
        return cls(entries, members, np.zeros(len(members)))

    def next(self, entries: np.ndarray) -> Codebook:
        move = np.sqrt(((entries - self.entries).astype(np.float64) ** 2).sum(axis=1))
        return Codebook(entries, self.members, np.array([move[some].max() for some in self.members]) * (1 + 1e-9))

    def assigned(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Entries, bounds and squared distances of points seen for the first time."""
        every = squared(points, self.entries)
        entry, rows = every.argmin(axis=1), np.arange(len(points))  # the first of equals
        best = every[rows, entry]
        far = every.max(initial=0) + 1
        every[rows, entry] = far
        lower = np.stack([rounded_down(every[:, some].min(axis=1)) for some in self.members], axis=1)
        return entry, lower, best, len(points) * len(self.members)

    def again(self, points: np.ndarray, entry: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same by the bounds; the last number is how many groups were scanned."""
        own = ((points - self.entries[entry]).astype(np.int64) ** 2).sum(axis=1)
        bound = np.maximum(lower.astype(np.float64) - self.moved, 0.0)
        scan = bound * bound * (1 - 1e-12) <= own[:, None]
        best, at = own.copy(), entry.copy()
        found: dict[int, tuple[np.ndarray, ...]] = {}
        for g, some in enumerate(self.members):
            rows = np.flatnonzero(scan[:, g])
            if len(rows):
                d = squared(points[rows], self.entries[some]).astype(np.int64)
                far = int(d.max()) + 1
                d[some == entry[rows][:, None]] = far
                place, i = d.argmin(axis=1), np.arange(len(rows))
                least, who = d[i, place], some[place]
                d[i, place] = far
                found[g] = rows, least, who, d.min(axis=1)
                valid = least < far
                better = valid & ((least < best[rows]) | ((least == best[rows]) & (who < at[rows])))
                best[rows[better]], at[rows[better]] = least[better], who[better]
        kept = np.minimum(bound, 60000.0).astype(np.float16)
        kept = np.maximum(np.nextafter(kept, np.float16(0)), np.float16(0))
        for g, (rows, least, who, second) in found.items():
            kept[rows, g] = rounded_down(np.where(who == at[rows], second, least))
        changed = np.flatnonzero(at != entry)
        g = self.group[entry[changed]]  # the entry left is one of its group's others now
        kept[changed, g] = np.minimum(kept[changed, g], rounded_down(own[changed]))
        return at, kept, best, int(scan.sum())


def _binary(matrix: np.ndarray) -> pa.Array:
    """A row's bytes as one value."""
    data = np.ascontiguousarray(matrix)
    width = data.nbytes // max(1, len(data))
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(np.arange(len(data) + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(data)])


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _walk(batch: pa.RecordBatch, books: list[Codebook], kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries, bounds, summed squared distances and scanned groups of a batch of state rows."""
    points = _matrix(batch.column("parts"), kind)
    cuts = np.split(points, len(books), axis=1)
    entry, lower = batch.column("entry"), batch.column("lower")
    if entry.null_count:
        told = [b.assigned(p) for b, p in zip(books, cuts, strict=True)]
    else:
        at, bound = _matrix(entry, np.uint8).astype(np.int64), _matrix(lower, np.float16)
        ends = np.cumsum([len(b.members) for b in books])[:-1]
        told = [b.again(p.astype(np.int64), at[:, i], low) for i, (b, p, low) in enumerate(zip(books, cuts, np.split(bound, ends, axis=1), strict=True))]
    entries, bounds, squares, scanned = zip(*told, strict=True)
    return np.stack(entries, axis=1).astype(np.uint8), np.concatenate(bounds, axis=1), sum(s.astype(np.int64) for s in squares), sum(scanned)


def assign(state: DataFrame, books: list[Codebook], kind: type, schema: str) -> DataFrame:
    """The state after one assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                entry, lower, _, scanned = _walk(batch, books, kind)
                share = pa.array(np.full(batch.num_rows, scanned // batch.num_rows, dtype=np.int32))
                yield pa.record_batch([*batch.columns[:3], _binary(entry), _binary(lower), share], ["vec_id", "label", "parts", "entry", "lower", "scanned"])

    return state.mapInArrow(run, schema)


def moved(state: DataFrame, books: list[Codebook], kind: type) -> list[Codebook]:
    """Codebooks at the floored means; entries without a part stay."""
    n, width = len(books[0].entries), books[0].entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books) * n, width + 1), dtype=np.int64)
        for batch in batches:
            entry = _matrix(batch.column("entry"), np.uint8)
            for i, part in enumerate(np.split(_matrix(batch.column("parts"), kind).astype(np.int64), len(books), axis=1)):
                np.add.at(total, entry[:, i].astype(np.int64) + i * n, np.c_[part, np.ones(len(part), dtype=np.int64)])
        used = np.flatnonzero(total[:, -1])
        yield pa.record_batch([pa.array(used), pa.array(list(total[used]), pa.list_(pa.int64()))], ["key", "sums"])

    sums = state.select("parts", "entry").mapInArrow(run, "key long, sums array<long>").select("key", F.posexplode("sums").alias("at", "x"))
    rows = sums.groupBy("key", "at").agg(F.sum("x").alias("x")).collect()  # parts * entries * (width + 1) numbers
    total = np.zeros((len(books) * n, width + 1), dtype=np.int64)
    for r in rows:
        total[r["key"], r["at"]] = r["x"]
    out = []
    for i, book in enumerate(books):
        mine = total[i * n : (i + 1) * n]
        used = mine[:, -1:] > 0
        out.append(book.next(np.where(used, mine[:, :-1] // np.maximum(mine[:, -1:], 1), book.entries)))
    return out


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, wanted: int = GROUPS) -> tuple[DataFrame | None, list[Codebook], type]:
    """The rows with the last round's entries and bounds, the final codebooks, and the components' type."""
    spark = vectors.sparkSession
    kept = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    size, reach = kept.agg(F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()
    if size is None:
        return None, [], np.int16
    width = max(1, -(-size // parts))
    top = int((reach or 0) * SCALE) + 1
    if width * (2 * top) ** 2 >= 1 << 63:
        raise ValueError(f"a component of {reach} is too large for exact squared distances in 64 bits")
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64

    def coded(lists: pa.Array) -> np.ndarray:
        flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(lists), parts * width), dtype=np.int64)
        rows = np.repeat(np.arange(len(lists)), lengths)
        out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.floor(flat.astype(np.float64) * SCALE)
        return out

    start = [r["embedding"] for r in kept.select("embedding", "vec_id").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()]
    firsts = np.split(coded(pa.array(start, pa.list_(pa.float64()))), parts, axis=1)
    books = [Codebook.first(f, wanted) for f in firsts]
    schema = STATE.format(id=vectors.schema["vec_id"].dataType.simpleString(), label=vectors.schema["label"].dataType.simpleString())

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, none = batch.num_rows, pa.nulls(batch.num_rows, pa.binary())
                yield pa.record_batch([*batch.columns[:2], _binary(coded(batch.column("embedding")).astype(kind)), none, none, pa.array(np.zeros(n, dtype=np.int32))], ["vec_id", "label", "parts", "entry", "lower", "scanned"])

    state, path = kept.select("vec_id", "label", "embedding").mapInArrow(begin, schema), ""
    for i in range(rounds):
        before, path = path, new_path(spark, f"round-{i}")
        assign(state, books, kind, schema).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        books = moved(state, books, kind)
        if before:
            remove(spark, before)
    return state, books, kind


def digest(books: list[Codebook]) -> str:
    """SHA-256 of all components in order of part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[Codebook]]:
    """``(vec_id, label, code, error)`` of every kept row, and the codebooks."""
    state, books, kind = train(vectors, parts, entries, rounds)
    fields = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, code string, error long"
    if state is None:
        return vectors.sparkSession.createDataFrame([], fields), books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                entry, _, error, _ = _walk(batch, books, kind)
                yield pa.record_batch([*batch.columns[:2], pa.array([row.tobytes().hex() for row in entry]), pa.array(error)], ["vec_id", "label", "code", "error"])

    return state.mapInArrow(run, fields), books


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    codes = cut(made.withColumn("_hw_label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))), "codes")
    labels = codes.groupBy("_hw_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("size"))
    out = met(codes, labels, ["_hw_label"], max(2, codes.count() // 1000), "inner")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The four rounds and the last assignment, each a step over the tables before it."""
    near = "SELECT p.vec_id, p.part, min(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + c.idx) AS best FROM parts p JOIN c{i} c USING (part) GROUP BY 1, 2"
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT vec_id, label, part, list_slice(v, 1 + part * len(v) // 4, (part + 1) * len(v) // 4) AS v FROM kept, (SELECT unnest(range(0, 4)) AS part))",
        "c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS idx, v FROM parts QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256)",
    ]
    for i in range(ROUNDS):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(i=i)})")
        steps.append(f"s{i} AS (SELECT part, idx, d, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p.part, best % 256 AS idx, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS d FROM parts p JOIN a{i} USING (vec_id, part)) GROUP BY 1, 2, 3)")
        steps.append(f"m{i} AS (SELECT part, idx, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM s{i} GROUP BY 1, 2)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.part, c.idx, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.idx = m.idx)")
    steps.append(f"f AS MATERIALIZED ({near.format(i=ROUNDS)})")
    steps.append("codes AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(to_hex(best % 256), 2, '0')), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error FROM f JOIN parts USING (vec_id, part) GROUP BY 1)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, idx)) AS h FROM c{ROUNDS})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM codes, h"


OP11_SQL = _sql()
