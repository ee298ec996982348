"""Node sets and node classes packed into bits, small enough to send to every task.

Ids are cut into buckets of ``2 ** 15``; a bucket is one row with an array of 64-bit words.
A set takes one bit an id and a running count for each word, so that a kept id's rank among
the kept ids is read from the same row; classes take four bits an id. At 279 million nodes
that is 52 MB and 140 MB. Edges meet such a table by a map-side join and aren't moved.
``fits`` says whether it may be sent. Beyond that, classes meet edges in a grid: nodes are cut
into blocks, an edge goes once to the cell of its ends' blocks, and the packed classes of
both blocks go there before it; a cell is split further, by a hash of the edge, until its
share is bounded, so a hub's edges are spread over a whole row of cells and their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ids of a bucket, as a power of two; Spark's bitmaps hold as many.
BUCKET = 15
WORDS = 1 << BUCKET - 6
#: A packed table is sent up to so many bytes.
BROADCAST_BYTES = 256 << 20
SET_BITS, CLASS_BITS = 1 + 32 / 64, 4
#: Ids of a block of the grid, as a power of two (its classes take 64 MB), and edges of a cell's part.
BLOCK, PART_EDGES = 27, 1 << 24


def fits(num_nodes: int, bits: float) -> bool:
    return num_nodes * bits / 8 <= BROADCAST_BYTES


def bucket_of(node: Column) -> Column:
    return F.shiftright(node, BUCKET)


def _place(node: Column) -> Column:
    return node.bitwiseAND(F.lit((1 << BUCKET) - 1)).cast("int")


def packed_set(ids: DataFrame, name: str = "id") -> DataFrame:
    """``(bucket, start, words, ranks)``: the bits, from each word's top bit down, and how many are set before each word.

    Built by Spark's bitmap aggregate, which combines within a task before it is exchanged.
    Its bits go up within a byte; they are turned round, so that eight bytes read as a
    number have the ids in order. ``start`` is the count of all buckets before, one row each.
    """
    node = F.col(name) + 1  # the bitmap functions count from 1
    place = F.bitmap_bit_position(node).bitwiseXOR(F.lit(7).cast("long"))
    maps = ids.groupBy(F.bitmap_bucket_number(node).alias("b")).agg(F.bitmap_construct_agg(place).alias("map"))
    word = lambda w: F.conv(F.hex(F.substring("map", w * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = maps.select((F.col("b") - 1).alias("bucket"), F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word).alias("words"), F.bitmap_count("map").alias("n"))
    zero = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))
    ranks = F.aggregate("words", zero, lambda s, w: F.struct((s["n"] + F.bit_count(w)).alias("n"), F.concat(s["out"], F.array(s["n"])).alias("out")), lambda s: s["out"])
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return words.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "words", ranks.alias("ranks"))


def rank_in(node: Column, start: Column, words: Column, ranks: Column) -> Column:
    """The rank of an id of the bucket among all ids of the set; null if it isn't one."""
    place = _place(node)
    at, offset = F.shiftright(place, 6), place.bitwiseAND(F.lit(63))
    word = F.get(words, at)
    has = F.call_function("shiftrightunsigned", word, F.lit(63) - offset).bitwiseAND(F.lit(1)) == 1
    above = F.bit_count(F.call_function("shiftrightunsigned", F.shiftrightunsigned(word, 1), F.lit(63) - offset))
    return F.when(has, start + F.get(ranks, at) + above)


def ranked_ends(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends in the packed set, under the ends' ranks; nothing is exchanged."""
    out = edges
    for end in ("src", "dst"):
        side = F.broadcast(kept.select(*[F.col(c).alias(f"_hw_{c}") for c in ("bucket", "start", "words", "ranks")]))
        rank = rank_in(F.col(end), F.col("_hw_start"), F.col("_hw_words"), F.col("_hw_ranks"))
        out = out.join(side, bucket_of(F.col(end)) == F.col("_hw_bucket")).select(*[c for c in edges.columns if c != end], rank.alias(end)).where(F.col(end).isNotNull())
    return out.select(*edges.columns)


def packed_classes(classes: DataFrame) -> DataFrame:
    """``(bucket, words)`` of ``(id, at)`` for every id from 0 on, ``at`` being from 0 to 15."""
    nibble = F.call_function("shiftleft", F.col("at").cast("long"), (F.col("id").bitwiseAND(F.lit(15)) * 4).cast("int"))
    words = classes.groupBy(F.shiftright("id", 4).alias("word")).agg(F.bit_or(nibble).alias("bits"))
    rows = words.groupBy(F.shiftright("word", BUCKET - 4).alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
    return rows.select("bucket", F.transform("w", lambda w: w["bits"]).alias("words"))


def class_in(node: Column, words: Column) -> Column:
    place = _place(node)
    return F.call_function("shiftrightunsigned", F.get(words, F.shiftright(place, 4)), place.bitwiseAND(F.lit(15)) * 4).bitwiseAND(F.lit(15)).cast("int")


def lesser_class(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """``(at)``: the lesser class of each edge's ends; nothing is exchanged."""
    out = edges.select("src", "dst")
    for end in ("src", "dst"):
        side = F.broadcast(classes.select(F.col("bucket").alias("_hw_bucket"), F.col("words").alias("_hw_words")))
        rest = [c for c in ("src", "dst", "src_at") if c in out.columns and c != end]
        out = out.join(side, bucket_of(F.col(end)) == F.col("_hw_bucket")).select(*rest, class_in(F.col(end), F.col("_hw_words")).alias(f"{end}_at"))
    return out.select(F.least("src_at", "dst_at").alias("at"))


def gridded_class(edges: DataFrame, classes: DataFrame, nodes: int, block: int | None = None, part_edges: int | None = None) -> DataFrame:
    """``(at)`` like ``lesser_class``, by one exchange of edges to the cells of a grid of blocks."""
    block, part_edges = BLOCK if block is None else block, PART_EDGES if part_edges is None else part_edges
    blocks = max(1, -(-nodes // (1 << block)))
    parts = max(1, -(-edges.count() // (part_edges * blocks)))  # as if one row of cells had all edges
    cell = lambda a, b, r: ((a * blocks + b) * parts + r).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("long")
    own = F.shiftright("bucket", block - BUCKET)
    spread = classes.select("bucket", "words", own.alias("own"), every(blocks).alias("other")).select("*", every(parts).alias("part"))
    held = [spread.select(cell(*at, F.col("part")).alias("cell"), F.lit(side).alias("side"), "bucket", "words", none.alias("src"), none.alias("dst")) for side, at in ((0, (F.col("own"), F.col("other"))), (1, (F.col("other"), F.col("own"))))]
    salt = F.pmod(F.xxhash64("src", "dst", "eid"), F.lit(parts))
    sent = edges.select(cell(F.shiftright("src", block), F.shiftright("dst", block), salt).alias("cell"), F.lit(2).alias("side"), F.lit(0).cast("long").alias("bucket"), F.lit(None).cast("array<long>").alias("words"), "src", "dst")
    size = 1 << block - 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, [np.zeros(0, np.uint64)] * 2
        for batch in batches:
            key = np.stack([batch.column("cell").to_numpy(), batch.column("side").to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                some = batch.slice(i, j - i)
                if key[i, 0] != now:
                    now, sides = key[i, 0], [np.zeros(size, np.uint64) for _ in range(2)]
                if key[i, 1] < 2:
                    for bucket, words in zip(some.column("bucket").to_pylist(), some.column("words"), strict=True):
                        at = (bucket << BUCKET - 4) % size
                        values = words.values.to_numpy()
                        sides[key[i, 1]][at : at + len(values)] = values.view(np.uint64)
                else:
                    ends = [some.column(c).to_numpy().astype(np.uint64) for c in ("src", "dst")]
                    at = [(x[(e >> np.uint64(4)) % np.uint64(size)] >> (e % np.uint64(16) * np.uint64(4))) & np.uint64(15) for x, e in zip(sides, ends, strict=True)]
                    yield pa.record_batch([pa.array(np.minimum(*at).astype(np.int32))], ["at"])

    rows = held[0].unionByName(held[1]).unionByName(sent)
    return rows.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(run, "at int")
