"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are numbered in a written table and fall into source buckets by a hash of their
content and number, so that rows alike, however many, spread over all buckets. How many rows each bucket
sends to each shard is drawn first: the matrix of a uniformly random arrangement, whose
row sums are the bucket sizes and whose column sums the shard sizes (at most one apart).
It is drawn top-down over a binary tree of buckets; a node splits its shard quotas by
hypergeometric draws, inverted from the exact distribution within twelve standard
deviations. Then each bucket is permuted by itself, cut by its matrix row, exchanged, and
each shard is permuted again (in ranges of hash values, so that no task holds a shard).

All of it is DataFrame expressions. Random numbers are hashes of a seed and the written
rows, so lost tasks are recomputed alike; files dealt otherwise are shuffled otherwise.
Defined results: null text counts no bytes and has CRC 0; a very long text is a row like
others, of which only size and CRC are moved; null ids are placed like others; repeated
rows are placed one by one; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hostweave.llm.common import cut, documents

#: Levels of the tree that are drawn from one array of counts; deeper trees take more rounds.
ROUND = 12


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Computes a value once and uses it in an expression."""
    return F.element_at(F.transform(F.array(value), lambda v: then(v)), 1)


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Good ones among ``drawn`` of ``total``, by inversion of the distribution at ``u``."""

    def inverted(p: Column) -> Column:
        places = F.sequence(p["a"] + 1, p["b"])
        dbl = lambda c: c.cast("double")
        ratio = lambda k: F.log(dbl(p["good"] - k + 1)) + F.log(dbl(p["n"] - k + 1)) - F.log(dbl(k)) - F.log(dbl(p["all"] - p["good"] - p["n"] + k))
        zero = F.lit(0.0)
        top = F.aggregate(places, F.struct(zero.alias("l"), zero.alias("m")), lambda s, k: _let(s["l"] + ratio(k), lambda l: F.struct(l.alias("l"), F.greatest(s["m"], l).alias("m"))), lambda s: s["m"])
        mass = lambda m: F.aggregate(places, F.struct(zero.alias("l"), F.exp(-m).alias("t"), m.alias("m")), lambda s, k: _let(s["l"] + ratio(k), lambda l: F.struct(l.alias("l"), (s["t"] + F.exp(l - s["m"])).alias("t"), s["m"].alias("m"))), lambda s: F.struct(s["m"].alias("m"), (s["t"] * p["u"]).alias("goal")))
        found = lambda g: F.aggregate(
            places,
            F.struct(zero.alias("l"), F.exp(-g["m"]).alias("c"), p["a"].alias("x"), g["m"].alias("m"), g["goal"].alias("goal")),
            lambda s, k: _let(s["l"] + ratio(k), lambda l: F.struct(l.alias("l"), (s["c"] + F.exp(l - s["m"])).alias("c"), F.when(s["c"] <= s["goal"], k).otherwise(s["x"]).alias("x"), s["m"].alias("m"), s["goal"].alias("goal"))),
            lambda s: s["x"],
        )
        return F.when(p["b"] <= p["a"], p["a"]).otherwise(_let(top, lambda m: _let(mass(m), found)))

    def bounded(q: Column) -> Column:
        share = q["good"].cast("double") / q["all"]
        mean = q["n"] * share
        reach = 12 * F.sqrt(F.greatest(F.lit(0.0), mean * (1 - share) * (q["all"] - q["n"]) / F.greatest(q["all"] - 1, F.lit(1)))) + 20
        low = F.greatest(F.lit(0).cast("long"), q["n"] - (q["all"] - q["good"]), F.floor(mean - reach).cast("long"))
        high = F.least(q["n"], q["good"], F.ceil(mean + reach).cast("long"))
        return F.struct(q["all"].alias("all"), q["good"].alias("good"), q["n"].alias("n"), q["u"].alias("u"), low.alias("a"), high.alias("b"))

    given = F.struct(total.cast("long").alias("all"), good.cast("long").alias("good"), drawn.cast("long").alias("n"), u.alias("u"))
    some = lambda q: F.when((q["good"] <= 0) | (q["n"] <= 0), F.lit(0).cast("long")).otherwise(_let(bounded(q), inverted))
    return _let(given, some)


def _split(quotas: Column, taken: Column, shards: int, seed: int, node: Column) -> Column:
    """How many of each shard's quota the first ``taken`` rows of a node get."""
    empty = F.array().cast(T.ArrayType(T.LongType(), False))
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, b: a + b)
    start = F.struct(total.alias("all"), taken.cast("long").alias("n"), empty.alias("out"))

    def step(s: Column, i: Column) -> Column:
        quota = F.get(quotas, i)
        return _let(hypergeometric(s["all"], quota, s["n"], _uniform(F.lit(seed), node, i)), lambda x: F.struct((s["all"] - quota).alias("all"), (s["n"] - x).alias("n"), F.concat(s["out"], F.array(x)).alias("out")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step, lambda s: s["out"])


def communication_matrix(sizes: DataFrame, buckets: int, rows: int, shards: int, seed: int, levels: int = ROUND) -> DataFrame:
    """``(bucket, counts array<long>)`` from ``(bucket, n)``; ``buckets`` is a power of two.

    Each round draws so many levels of the tree: a node gets the counts of its descendants
    at the round's end as an array (at most ``2 ** levels`` numbers) and is split in halves.
    """
    spark = sizes.sparkSession
    depth, total = 0, buckets.bit_length() - 1
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(sizes, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    quotas = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("long") for s in range(shards)])
    tree = spark.range(1).select(F.lit(1).cast("long").alias("node"), quotas.alias("quotas"))
    while depth < total:
        step = min(levels, total - depth)
        ends = every.groupBy(F.shiftright("bucket", total - depth - step).alias("end")).agg(F.sum("n").alias("n"))
        counts = ends.groupBy((F.shiftright("end", step) + (1 << depth)).alias("node")).agg(F.sort_array(F.collect_list(F.struct("end", "n"))).alias("x"))
        tree = tree.join(counts, "node").select("node", "quotas", F.transform("x", lambda x: x["n"]).alias("sizes"))
        width = 1 << step
        while width > 1:
            half = width // 2
            left = F.aggregate(F.slice("sizes", 1, half), F.lit(0).cast("long"), lambda a, b: a + b)
            tree = tree.select("node", "quotas", "sizes", _split(F.col("quotas"), left, shards, seed, F.col("node")).alias("left"))
            children = F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas"), F.slice("sizes", 1, half).alias("sizes")),
                F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas"), F.slice("sizes", half + 1, half).alias("sizes")),
            )
            tree = tree.select(F.explode(children).alias("c")).select("c.*")
            if depth == 0 and (1 << step) // half in (8, 64):
                tree = tree.repartition("node")  # the rest of the tree is shared out as soon as there are some nodes
            width = half
        tree = tree.select("node", "quotas")
        depth += step
        if depth < total:
            tree = cut(tree, f"matrix-{depth}")
    return tree.select((F.col("node") - buckets).alias("bucket"), F.col("quotas").alias("counts"))


def shuffled(docs: DataFrame, shards: int = 40, seed: int = 20240, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 4096) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = cut(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")  # fixed once it is written
    n = numbered.count()
    buckets = 8
    while buckets * rows_per_bucket < n:
        buckets *= 2
    content = [F.col(c) for c in ("doc_id", "size", "text_crc32", "row")]
    placed = numbered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), *content), F.lit(buckets)))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    matrix = communication_matrix(sizes, buckets, n, shards, seed + 1)
    within = Window.partitionBy("bucket").orderBy(F.xxhash64(F.lit(seed + 2), *content), *content)
    ranked = placed.withColumn("rank", F.row_number().over(within) - 1)
    zero = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("shard"))
    to = F.aggregate("counts", zero, lambda s, c: F.struct((s["seen"] + c).alias("seen"), F.when(s["seen"] + c <= F.col("rank"), s["shard"] + 1).otherwise(s["shard"]).alias("shard")), lambda s: s["shard"])
    sent = ranked.join(matrix, "bucket").select("doc_id", "size", "text_crc32", to.alias("shard"), "bucket", "rank")
    ranges = max(1, -(-n // (shards * rows_per_bucket)))
    again = _uniform(F.lit(seed + 3), F.col("bucket"), F.col("rank"))
    sent = cut(sent.select("doc_id", "size", "text_crc32", "shard", "bucket", "rank", again.alias("u"), F.floor(again * ranges).alias("part")), "exchanged")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sent.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "part").orderBy("u", "bucket", "rank")
    ready = sent.withColumn("place", F.row_number().over(order) - 1).join(offsets, ["shard", "part"])
    return ready.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shuffled(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
