"""Interaction audit of five document filters in all 120 orders.

Each document gets a mask of the filters that it fails; everything in the report follows
from the counts of the masks within a part. Filters A to D look at the document alone. E,
a text that a smaller id has too, is found by partition refinement: documents are split by
length in code points, then by the hash of one block of text after another, and a class
of one is dropped at once. The texts of the classes left are compared whole; all but the
least id of equal texts are marked. Block hashes only ever separate, so a chance equality
of hashes costs a comparison and never a wrong mark.

One scan writes a narrow row for each document (ids, mask, length, block hashes); the
rounds run over these. A class is counted with partial sums, and classes with over one row
in 1000 (so at most 1000) are met by broadcast, the others by merge joins; so a class with
a third of all rows is no task's load. Marks change the counts of masks: each moves one
document from its mask to that with E, and no document is joined again.

Defined results: null text is the empty text; a null source is the part of the empty
string; a null doc_id is never marked, nor marks another; rows that share an id and a text
don't mark each other; labels of one id are combined by the greatest value, and null labels
are no labels; very long texts are judged whole; an empty table gives an empty report;
extra columns are not read.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut, documents, met, sides

WORD_GAP = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
#: Code points in each block but the last, which has the rest of the text.
BLOCKS = (64, 1984)
#: A class with over this share of the rows is met by broadcast.
HEAVY = 1000


def failures(text: Column, words: Column) -> Column:
    """Bits 0 to 3: fails A (short), B (repetitive), C (capitals), D (symbols)."""
    n = F.size(words)
    fails = (n < 200, F.size(F.array_distinct(words)) * 100 < n * 50, F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 2, text.rlike("[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))


def signature(text: Column, bits: int = 64) -> dict[str, Column]:
    """The length and the block hashes, in the order in which they split (fewer ``bits``: for tests)."""
    out, at = {"n": F.length(text)}, 1
    for i, size in enumerate((*BLOCKS, (1 << 31) - 1)):
        h = F.xxhash64(F.substring(text, at, size))
        out[f"b{i}"] = h if bits == 64 else h.bitwiseAND(F.lit((1 << bits) - 1))
        at += size
    return out


def judged(docs: DataFrame, labels: DataFrame, bits: int = 64) -> DataFrame:
    """``(doc_id, text, part, mask, good, toxic, n, b0, ...)``, E not yet in the mask."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    text = F.col("text")
    rows = rows.withColumn("words", F.array_remove(F.split(text, WORD_GAP), "")).withColumns({"mask": failures(text, F.col("words")), **signature(text, bits)})
    return rows.drop("words").join(told, "doc_id", "left").na.fill(0, ["good", "toxic"])


def surviving(rows: DataFrame, keys: list[str], total: int) -> tuple[DataFrame, DataFrame, int]:
    """Refines by one key after another; the rows of classes of two and more, those classes, and what counts as heavy."""
    heavy = max(2, total // HEAVY)
    for i in range(1, len(keys) + 1):
        by = keys[:i]
        classes = cut(rows.groupBy(*by).agg(F.count("*").alias("size")).where("size > 1"), f"classes-{i}")
        rows = cut(met(rows, classes, by, heavy, "left_semi"), f"rows-{i}")
    return rows, classes, heavy


def marks(docs: DataFrame, labels: DataFrame, narrow: DataFrame, bits: int = 64) -> DataFrame:
    """``(part, mask, good, toxic)`` of every document that fails E."""
    keys, columns = list(signature(F.lit(""))), ["part", "mask", "good", "toxic"]
    rows, classes, heavy = surviving(narrow, keys, narrow.count())
    whole = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumns(signature(F.col("text"), bits))
    large, small = sides(whole, classes, keys, heavy, "left_semi", "shuffle_hash")
    firsts = [some.groupBy(*keys, "text").agg(F.min("doc_id").alias("first")).drop("text") for some in (large, small)]  # compares whole texts
    compared = cut(firsts[0].unionByName(firsts[1]), "compared")
    found = compared.groupBy(*keys).agg(F.count("*").alias("texts"), F.min("first").alias("first"))
    one = cut(found.join(classes.hint("merge"), keys), "firsts")
    marked = met(rows, one.where("texts = 1"), keys, heavy, "inner").where(F.col("doc_id") > F.col("first")).select(*columns)
    mixed = one.where("texts > 1").select(*keys)  # different texts under equal hashes: each has a first of its own
    if mixed.head(1):
        own = judged(docs, labels, bits).join(mixed, keys, "left_semi")
        by_text = own.groupBy(*keys, "text").agg(F.min("doc_id").alias("first"))
        marked = marked.unionByName(own.join(by_text, [*keys, "text"]).where(F.col("doc_id") > F.col("first")).select(*columns))
    return marked


def audit(docs: DataFrame, labels: DataFrame, bits: int = 64) -> DataFrame:
    """A row for each part, order and step; see the module text."""
    every = ["part", "mask", "good", "toxic"]
    narrow = cut(judged(docs, labels, bits).drop("text"), "narrow")
    moved = marks(docs, labels, narrow, bits).groupBy(*every).agg(F.count("*").alias("k"))
    moves = moved.select("part", F.explode(F.array(F.struct("mask", (-F.col("k")).alias("k")), F.struct((F.col("mask") + 16).alias("mask"), F.col("k").alias("k")))).alias("m"), "good", "toxic")
    counts = narrow.groupBy(*every).agg(F.count("*").alias("k")).unionByName(moves.select("part", "m.mask", "good", "toxic", "m.k"))
    masks = counts.groupBy("part", "mask").agg(*[F.sum(F.col("k") * F.col(w) if w else F.col("k")).alias(n) for n, w in (("k", None), ("good", "good"), ("toxic", "toxic"))])
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "k", "good", "toxic")).alias("masks"))  # 32 at most
    steps = [{"o": "".join(order), "s": s + 1, "f": 1 << FILTERS.index(order[s]), "p": sum(1 << FILTERS.index(x) for x in order[:s])} for order in itertools.permutations(FILTERS) for s in range(5)]
    laid = parts.select("part", "masks", F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<o string, s int, f int, p int>>")).alias("x"))
    f, before = F.col("x.f"), F.col("x.p")

    def over(use, value) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(use(m["mask"]), value(m)).otherwise(0))

    has, had = lambda m: m.bitwiseAND(f) > 0, lambda m: m.bitwiseAND(before) > 0
    shares = F.array(*[F.lit(120 // i).cast("long") for i in range(1, 6)])  # orders in which one of i failed filters is first
    here = lambda m: has(m) & ~had(m)
    k = lambda m: m["k"]
    return laid.select(
        "part",
        F.col("x.o").alias("filter_order"),
        F.col("x.s").alias("step"),
        over(lambda m: ~has(m) & ~had(m), k).alias("kept"),
        over(here, k).alias("removed"),
        over(lambda m: has(m) & had(m), k).alias("redundant"),
        over(lambda m: m == f, k).alias("unique_fails"),
        over(here, lambda m: m["good"]).alias("good_lost"),
        over(here, lambda m: m["toxic"]).alias("toxic_lost"),
        over(has, lambda m: m["k"] * F.element_at(shares, F.bit_count(m["mask"]))).alias("shapley"),
    )


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
g AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INTEGER) AS good, max((coalesce(toxic, 0) = 1)::INTEGER) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INTEGER + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER + 16 * (doc_id > first)::INTEGER AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, mask, count(*) AS k, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS o FROM l p, l q, l r, l s, l t WHERE p.x <> q.x AND p.x <> r.x AND p.x <> s.x AND p.x <> t.x AND q.x <> r.x AND q.x <> s.x AND q.x <> t.x AND r.x <> s.x AND r.x <> t.x AND s.x <> t.x),
y AS (SELECT o, s, (1 << (ascii(substr(o, s, 1)) - 65))::INTEGER AS f, list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(substr(o, i::BIGINT, 1)) - 65))) AS b FROM o, (SELECT unnest(range(1, 6)) AS s)),
z AS (SELECT o, s, f, coalesce(b, 0)::INTEGER AS b FROM y)
SELECT part, o AS filter_order, s::INTEGER AS step,
 sum(CASE WHEN mask & (f | b) = 0 THEN k ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN mask & f > 0 AND mask & b = 0 THEN k ELSE 0 END)::BIGINT AS removed,
 sum(CASE WHEN mask & f > 0 AND mask & b > 0 THEN k ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = f THEN k ELSE 0 END)::BIGINT AS unique_fails,
 sum(CASE WHEN mask & f > 0 AND mask & b = 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN mask & f > 0 AND mask & b = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
 sum(CASE WHEN mask & f > 0 THEN k * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM c, z GROUP BY 1, 2, 3
"""
