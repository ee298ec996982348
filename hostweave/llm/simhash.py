"""SimHash near-duplicate detection by multi-index hashing.

A 64-bit fingerprint is the bitwise majority of the XXH64 hashes of a document's word
shingles. Two fingerprints are linked when they differ in at most ``distance`` bits.
Links are found without comparing all pairs: the 64 bits are cut into segments with
radii whose ``sum(radius + 1)`` exceeds ``distance``; by the pigeonhole principle two
linked fingerprints differ by at most the radius in at least one segment, so every
fingerprint is stored once per segment table and looked up under every value in the
small Hamming ball around its segment. Matches are verified on all 64 bits.

Exact copies collapse to one fingerprint before any lookup. Within a table value only a
spanning forest of the verified links is emitted (never all pairs of a group), and the
forests are merged by distributed star contraction.

``deduplicated``, the pipeline's stage, takes the components of these links as groups of
candidates, adds groups by min-hash keys, and links only pairs whose shingle sets are similar
enough, computed exactly.

Defined results: null or wordless text has fingerprint zero, which links like any other;
repeated rows get the same component; null ids are kept (a component whose ids are all
null has a null component_id); very long texts are hashed whole, in blocks; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut, documents, map_batches, raw

#: A group of one table value with more members is linked by a frontier search.
SMALL_GROUP = 64
#: Texts of one group that are compared in one task, and their bytes (twice as many where a group is in parts).
CHUNK, CHUNK_BYTES = 4096, 16 << 20


def _majority(hashes: np.ndarray) -> int:
    """Bit by bit: set in over half of the hashes."""
    n = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 255 * 256):
        part = hashes[at : at + 255 * 256]
        rows = -(-len(part) // 255)
        bits = np.zeros((rows * 255, 64), dtype=np.uint8)
        bits[: len(part)] = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits.reshape(rows, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def simhash(text: bytes, width: int = 4, seed: int = 42, words: int = 1) -> tuple[int, ...]:
    """Fingerprint of one UTF-8 text: unsigned 64-bit words, the later ones from remixed hashes."""
    tokens = text.lower().split()  # on bytes: ASCII case and ASCII white space only
    if not tokens:
        return (0,) * words
    n = max(1, len(tokens) - width + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(tokens[i : i + width]), seed) for i in range(n)), dtype="<u8", count=n)
    out = [_majority(hashes)]
    for k in range(1, words):
        mixed = hashes + np.uint64(0x9E3779B97F4A7C15 * k % 2**64)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(_majority(mixed ^ (mixed >> np.uint64(31))))
    return tuple(out)


def _columns(values: list[tuple[int, ...]], words: int) -> list[pa.Array]:
    """The words of fingerprints as signed columns."""
    table = np.array(values, dtype=np.uint64).reshape(-1, words).view(np.int64)
    return [pa.array(np.ascontiguousarray(table[:, k])) for k in range(words)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed 64-bit integer."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), *_columns([simhash(t, width, seed) for t in raw(batch, "text")], 1)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, one, "doc_id long, fp long")


def segments(distance: int, tables: int) -> list[tuple[int, int, int]]:
    """``(offset, bits, radius)`` of each table, widest balls in the widest segments."""
    spare = distance - tables + 1
    if tables < 2 or spare < 0:
        raise ValueError("2 <= tables <= distance + 1 is needed")  # a segment has 32 bits at most
    radii = [spare // tables + (i < spare % tables) for i in range(tables)]
    base = [64 // tables + (i < 64 % tables) for i in range(tables)]
    if radii[0] != radii[-1]:  # a ball costs lookups, so give its segment more bits
        base[-1] -= 1
        base[-2] += 1
    out, at = [], 0
    for bits, radius in zip(base, radii, strict=True):
        out.append((at, bits, radius))
        at += bits
    return out


def ball(bits: int, radius: int) -> list[int]:
    """XOR masks of weight up to ``radius`` over ``bits`` bits; zero is first."""
    masks, layer = [0], {0}
    for _ in range(radius):
        layer = {m | (1 << b) for m in layer for b in range(bits) if not m >> b & 1}
        masks += sorted(layer)
    return masks


def _probe_rows(fps: DataFrame, distance: int, tables: int) -> DataFrame:
    """One stored row and one row per ball member and table: ``(key, *columns, own)``."""
    parts: list[Column] = []
    for i, (at, bits, radius) in enumerate(segments(distance, tables)):
        own = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(i << 32)
        parts.append(F.array(*[F.struct(own.bitwiseXOR(F.lit(m)).alias("key"), F.lit(m == 0).alias("own")) for m in ball(bits, radius)]))
    return fps.select("*", F.explode(F.concat(*parts)).alias("p")).select("p.key", *fps.columns, "p.own")


class _Forest:
    """Union-find over the fingerprints of one task; keeps only links that merge."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _near(a: np.ndarray, b: np.ndarray, limits: tuple[int, ...]) -> np.ndarray:
    """Whether fingerprints (words by row) are within the limit of the first word and of all."""
    bits = np.bitwise_count((a[..., 0] ^ b[..., 0]).view(np.uint64))  # of a signed integer it would count the absolute value's bits
    near = bits <= limits[0]
    if a.shape[-1] > 1 and near.any():
        rest = np.bitwise_count((np.broadcast_to(a, b.shape)[near, 1:] ^ b[near, 1:]).view(np.uint64)).sum(axis=-1)
        near[near] = bits[near] + rest <= limits[-1]
    return near


def _group_links(fp: np.ndarray, own: np.ndarray, limits: tuple[int, ...]) -> Iterator[tuple[int, int]]:
    """A spanning forest (of places) of the links of one large table value, by frontier search.

    Each reached member is compared only with members not reached yet, so a dense group
    costs about one pass. Pairs of two probes need no link here: each has a table value
    where it is stored; so a search begins at stored members only.
    """
    left = np.r_[np.flatnonzero(own), np.flatnonzero(~own)]
    stored = int(own.sum())
    while stored and len(left):
        frontier, left, stored = [left[0]], left[1:], stored - 1
        while frontier and len(left):
            at = frontier.pop()
            some = left if own[at] else left[:stored]
            hit = _near(fp[at][None], fp[some], limits)
            if hit.any():
                got = some[hit]
                for other in got:
                    yield int(at), int(other)
                stored -= int(own[got].sum())
                left = np.r_[some[~hit], left[len(some) :]]
                frontier.extend(got.tolist())


def find_links(fps: DataFrame, distance: int = 4, tables: int = 3, total: int | None = None) -> DataFrame:
    """Links ``(a, b)`` of nodes whose connected components are those of all true links.

    ``fps`` has the first word ``fp``, which the tables are over, maybe further words
    (columns ``fp2``, ...), and maybe a column ``node`` (else ``fp`` is the node). Linked
    are nodes within ``distance`` on the first word and, of all words, within ``total``.
    """
    names = [c for c in fps.columns if c.startswith("fp")]
    limits = (distance, distance if total is None else total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, rest = _Forest(), None

        def links(key: np.ndarray, own: np.ndarray, node: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.diff(key)) + 1
            start, end = np.r_[0, edge], np.r_[edge, len(key)]
            size = end - start
            held = np.add.reduceat(own.astype(np.int64), start)
            use = (held > 0) & (size > 1)
            small = use & (size <= SMALL_GROUP)
            rows = np.flatnonzero(np.repeat(small, size) & own)
            begin, upto = np.repeat(start, size)[rows], np.repeat(end, size)[rows]
            pairs: list[Iterable[tuple[int, int]]] = []
            for some in np.array_split(np.arange(len(rows)), len(rows) * SMALL_GROUP // 1_000_000 + 1):
                many = upto[some] - begin[some]
                i = np.repeat(rows[some], many)
                j = np.repeat(begin[some], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                ok = (~own[j]) | (j > i)
                i, j = i[ok], j[ok]
                ok = _near(fp[i], fp[j], limits)
                pairs.append(zip(i[ok].tolist(), j[ok].tolist(), strict=True))
            pairs += [[(x + s, y + s) for x, y in _group_links(fp[s:e], own[s:e], limits)] for s, e in zip(start[use & ~small].tolist(), end[use & ~small].tolist(), strict=True)]
            a: list[int] = []
            b: list[int] = []
            for found in pairs:
                for x, y in found:
                    x, y = int(node[x]), int(node[y])
                    if x != y and forest.link(x, y):
                        a.append(x)
                        b.append(y)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            key, own, node = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "own", "node"))
            fp = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            if rest is not None:
                key, own, node, fp = (np.concatenate(x) for x in zip(rest, (key, own, node, fp), strict=True))
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1])  # the last value may go on in the next batch
            rest = (key[last:], own[last:], node[last:], fp[last:])
            if last:
                yield links(key[:last], own[:last], node[:last], fp[:last])
        if rest is not None:
            yield links(*rest)

    rows = fps.select(*names, "node" if "node" in fps.columns else F.col("fp").alias("node"))
    return _probe_rows(rows, distance, tables).repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of a link, root being the least node reachable.

    Alternating star contraction: each round moves every neighbour to the least
    neighbour, which ends after about log(nodes) rounds. Rounds end in written tables, so
    no round's lineage is longer than one contraction.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = cut(small, "stars")
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(state)
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, distance: int = 4, tables: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row; see the module text for edge cases."""
    fps = cut(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(find_links(least, distance, tables))
    named = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.select("fp", "root").join(group, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def shingles(text: bytes, width: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different word shingles (a shorter text is one)."""
    tokens = text.lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(tokens) - width + 1) if tokens else 0
    return np.unique(np.fromiter((digest(join(tokens[i : i + width]), seed) for i in range(n)), dtype="<u8", count=n))


def band_keys(found: np.ndarray, bands: int, size: int, seed: int = 42) -> np.ndarray:
    """One key a band, of ``size`` least values of the shingles under different hashes each."""
    rng = np.random.default_rng(seed)
    factor, offset = rng.integers(0, 2**64, (2, bands * size, 1), dtype=np.uint64)
    factor |= np.uint64(1)
    least = np.full(bands * size, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        mixed = found[at : at + 4096] * factor + offset
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
    key = np.arange(bands, dtype=np.uint64)
    for part in least.reshape(bands, size).T:
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def similar_stars(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """``(first, member)`` of each component of the sets that share ``least`` or more (exact Jaccard).

    Each reached set is compared with those not reached yet, so a dense group costs about
    one pass and no more than one link a member is returned.
    """
    size = np.array([len(x) for x in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    own = np.split(number, np.cumsum(size)[:-1])
    mark = np.zeros(int(number.max(initial=-1)) + 1, dtype=bool)
    left = np.flatnonzero(size)
    out = []
    while len(left) > 1:
        centre, left = int(left[0]), left[1:]
        frontier = [centre]
        flat, start = np.concatenate([own[i] for i in left]), np.cumsum(size[left]) - size[left]
        while frontier and len(left):
            at = frontier.pop()
            mark[own[at]] = True
            both = np.add.reduceat(mark[flat], start, dtype=np.int64)
            mark[own[at]] = False
            hit = both >= least * (size[left] + size[at] - both) - 1e-9
            if hit.any():
                frontier += left[hit].tolist()
                out += [(centre, i) for i in left[hit].tolist()]
                flat = flat[np.repeat(~hit, size[left])]
                left = left[~hit]
                start = np.cumsum(size[left]) - size[left]
    return out


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Bounds of whole groups, and their rows, of batches that are sorted by the first column."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        if rest and key[-1] == last:  # one group goes on through the whole batch
            rest.append(batch)
            continue
        cut_at = int(np.searchsorted(key, key[-1]))
        if rest or cut_at:
            whole = pa.Table.from_batches([*rest, batch.slice(0, cut_at)])
            yield np.flatnonzero(np.diff(whole.column(0).to_numpy(), prepend=~whole.column(0)[0].as_py(), append=~whole.column(0)[-1].as_py())), whole
        rest, last = [batch.slice(cut_at)], key[-1]
    if rest:
        whole = pa.Table.from_batches(rest)
        yield np.flatnonzero(np.diff(whole.column(0).to_numpy(), prepend=~whole.column(0)[0].as_py(), append=~whole.column(0)[-1].as_py())), whole


def parts_of(sizes: np.ndarray, chunk: int, most: int) -> np.ndarray:
    """The part of each node: as many nodes in order as stay within ``chunk`` and ``most`` bytes, one at least."""
    part, count, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    if len(sizes) <= chunk and int(sizes.sum()) <= most:
        return part
    for i, size in enumerate(sizes.tolist()):
        if count and (count >= chunk or held + size > most):
            part[i:] += 1
            count = held = 0
        count, held = count + 1, held + size
    return part


def candidates(keys: DataFrame, chunk: int = CHUNK, most: int = CHUNK_BYTES) -> DataFrame:
    """``(group, node)`` of the groups of nodes to compare, from ``(node, bands, size)``.

    Nodes with a band key in common are a group; a group that several bands make is
    returned once. One of over ``chunk`` nodes, or ``most`` bytes of text, is dealt into
    parts, and each two parts are a group, so a task's memory is bounded (by two texts, if
    they are larger) and still every pair meets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bound, table in _by_key(batches):
            nodes, sizes = table.column(1).to_numpy(), table.column(2).to_numpy()
            group: list[np.ndarray] = []
            member: list[np.ndarray] = []
            for i, j in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                if j - i < 2:
                    continue
                turn = np.argsort(nodes[i:j], kind="stable")
                some = nodes[i:j][turn]
                name = xxhash.xxh64_intdigest(some.tobytes())
                part = parts_of(sizes[i:j][turn], chunk, most)
                parts = int(part[-1]) + 1
                for x in range(parts):
                    for y in range(x, parts) if parts == 1 else range(x + 1, parts):
                        held = some[(part == x) | (part == y)]
                        group.append(np.full(len(held), xxhash.xxh64_intdigest(f"{x} {y}".encode(), name), dtype=np.uint64))
                        member.append(held)
            if group:
                yield pa.record_batch([pa.array(np.concatenate(group).view(np.int64)), pa.array(np.concatenate(member))], ["group", "node"])

    rows = keys.select(F.explode("bands").alias("key"), "node", "size")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "group long, node long").distinct()


def verified(members: DataFrame, width: int, seed: int, least: float) -> DataFrame:
    """Links ``(a, b)`` by exact similarity within each group of ``(group, node, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bound, table in _by_key(batches):
            nodes, data = table.column(1).to_numpy(), table.column(2)
            links: list[tuple[int, int]] = []
            for i, j in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                sets = [shingles(t, width, seed) for t in data.slice(i, j - i).cast(pa.binary()).to_pylist()]
                links += [(int(nodes[i + x]), int(nodes[i + y])) for x, y in similar_stars(sets, least)]
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return members.select("group", "node", "text").repartition("group").sortWithinPartitions("group", "node").mapInArrow(run, "a long, b long")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, seed: int = 42, least: float = 0.8, bands: int = 24, size: int = 5) -> DataFrame:
    """One row of each near-duplicate group, all columns as they are.

    The row with the least id stays (null ids last; of rows with one id and different texts, that of the
    least text hash; of rows alike in both, any one). Two texts are linked when the sets
    of their ``width``-word shingles share ``least`` or more, which is always computed from
    the texts. Compared are texts whose SimHash fingerprints are linked, directly or through others (by
    multi-index hashing, as in ``near_duplicates``), and texts that agree in one of ``bands`` min-hash keys: with the
    defaults a pair at 0.8 meets with probability 0.9999, and one at 0.5 in about half of
    all cases. Texts without a word are alike. Very long texts are compared whole. An empty
    table stays one; columns of any name pass through.

    Rows are known by id and text hash. Whole rows move twice: the candidates' texts to where they
    are compared, and at the end to where the rows that stay are. Both are merge joins at
    every size, as neither side has a bound.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, width, seed) for t in raw(batch, "text")]
        whole = np.array([divmod(xxhash.xxh3_128_intdigest(x.tobytes()), 2**64) for x in sets], dtype=np.uint64).reshape(-1, 2).view(np.int64)
        found = [band_keys(x, bands, size, seed).view(np.int64) if len(x) else [] for x in sets]
        marks = _columns([simhash(t, seed=seed) for t in raw(batch, "text")], 1)
        octets = pa.array([len(t) for t in raw(batch, "text")], pa.int64())
        return pa.record_batch([*batch.columns[:2], *(pa.array(np.ascontiguousarray(whole[:, k])) for k in (0, 1)), pa.array(found, pa.list_(pa.int64())), octets, *marks], ["id", "hash", "fp", "fp2", "bands", "size", "mark"])

    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    hashed = map_batches(docs.select(F.col(id_col).alias("id"), text_hash.alias("hash"), F.col(text_col).alias("text")), one, f"id {docs.schema[id_col].dataType.simpleString()}, hash long, fp long, fp2 long, bands array<long>, size long, mark long")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash"))
    keys = cut(hashed.groupBy("fp", "fp2").agg(first.alias("first"), F.min("bands").alias("bands"), F.max("size").alias("size"), F.min("mark").alias("mark")).withColumn("node", F.monotonically_increasing_id()), "shingled")
    marked = keys.where(F.size("bands") > 0)  # texts with a word
    linked = components(find_links(marked.select(F.col("mark").alias("fp")).distinct())).withColumnsRenamed({"node": "mark"})
    met_by = F.concat("bands", F.array(F.coalesce("root", "mark")))
    groups = cut(candidates(marked.join(linked, "mark", "left").select("node", met_by.alias("bands"), "size")), "candidates")
    kind = f"struct<id: {docs.schema[id_col].dataType.simpleString()}, hash: bigint>"  # both sides' fields may be null, else Spark deals the sides out by a cast of one
    key = lambda i, h: F.struct(i.alias("id"), h.alias("hash")).cast(kind).alias("_hw_key")  # noqa: E731  a null within a struct equals another
    mine, of_first = key(F.col(id_col), text_hash), key(F.col("first.id"), F.col("first.hash"))
    asked = groups.join(keys.select("node", of_first), "node")
    own = docs.select(mine, F.col(text_col).alias("text"))
    texts_of = own.join(asked.select("_hw_key").distinct().hint("shuffle_hash"), "_hw_key", "left_semi").groupBy("_hw_key").agg(F.min("text").alias("text"))
    links = verified(texts_of.join(asked.hint("merge"), "_hw_key").select("group", "node", "text"), width, seed, least)
    roots = components(links)
    best = keys.select("node", "first").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select(of_first)
    rows = docs.select(mine, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_hw_row")).dropDuplicates(["_hw_key"])
    return rows.join(best.hint("merge"), "_hw_key", "left_semi").select("_hw_row.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
