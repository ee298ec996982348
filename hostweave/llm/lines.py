"""Line deduplication by hashes in ranges; decisions come back as keep bitmaps, not as text.

A line's key is the line without white space at its ends, A-Z lower-cased. Long keys that
occur in ``min_docs`` documents or more stay in the document of the largest id only.

Lines leave their document once, as 96 bits of hash with the document's id, its text's
hash and the line's place. Hash ranges are dealt to tasks and sorted by key, document and
place; in that order the first document of a key keeps its lines, and a running comparison
with the row before counts documents. A key with over about one row in 256 would be one
task's work: such keys (at most 256, found by the frequent-items sketch; were one missed,
the result would be the same) are counted with partial sums and judged where their rows are.

What is dropped is gathered as 64-line words: ``keep`` has the words in which something is
dropped, all other lines stay. Only ``deduplicated`` moves texts, once, to their bitmaps.

All of it is DataFrame expressions. Defined results: a null or empty text is one empty
line; a document is a doc_id, so rows that share an id count once and stay or go together,
each by its own lines; rows alike in id and text share a bitmap; a null id is one document,
below all others; a key twice in the document that keeps it stays twice; very long texts
are split like others; an empty table gives an empty result; extra columns are not read.
Two keys are mixed up with a chance of about ``k * k / 2**97`` among ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostweave.llm.common import cut, documents
from hostweave.llm.shards import _let

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys with over this share of the rows are judged apart; there are at most ``1 / HOT``.
HOT = 1 / 256


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; the fast way where every character is one byte."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40) -> DataFrame:
    """``(doc_id, text_hash, pos, h1, h2)`` of the lines whose keys are long enough."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(ascii_lower(text), "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "text_hash", "pos", F.btrim("line", F.lit(SPACE)).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))


def dropped_lines(rows: DataFrame, min_docs: int = 5) -> DataFrame:
    """``(doc_id, text_hash, pos)`` of the lines that go, from the lines' hashes."""
    hot = rows.freqItems(["h1"], HOT).first()[0] if rows.head(1) else []
    is_hot = F.col("h1").isin(*hot)
    some = rows.where(is_hot)
    judged = some.groupBy("h1", "h2", "doc_id").count().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
    often = some.join(F.broadcast(judged.where(F.col("docs") >= min_docs)), ["h1", "h2"])  # keys of at most 256 hashes

    ranged = rows.where(~is_hot).repartitionByRange("h1", "h2")
    key = Window.partitionBy("h1", "h2")
    order = key.orderBy(F.desc_nulls_last("doc_id"), "text_hash", "pos")
    first = (F.row_number().over(order) == 1) | ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(order))
    streamed = ranged.withColumns({"first": first, "last": F.first("doc_id").over(order)}).withColumn("docs", F.sum(F.col("first").cast("int")).over(key))
    gone = lambda df: df.where((F.col("docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "text_hash", "pos")
    return gone(often).unionByName(gone(streamed))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``(doc_id, text_hash, keep array<struct<word, bits>>)`` of the documents that lose lines.

    Bit ``i`` of word ``w`` says whether line ``64 * w + i`` stays; words that aren't there stay whole.
    """
    rows = cut(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    word, bit = F.shiftright("pos", 6).alias("word"), F.expr("shiftleft(1L, pos & 63)")
    words = dropped_lines(rows, min_docs).groupBy("doc_id", "text_hash", word).agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that stay, joined again."""
    lines = F.split(text, "\n")
    held = F.map_from_entries(keep)
    dense = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(lines) - 1, 6)), lambda w: F.coalesce(F.try_element_at(held, w), F.lit(-1).cast("long")))
    stays = lambda words: F.filter(lines, lambda _, i: F.getbit(F.get(words, F.shiftright(i, 6)), i.bitwiseAND(F.lit(63))) == 1)
    return F.when(keep.isNull(), text).otherwise(_let(dense, lambda words: F.array_join(stays(words), "\n")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows and columns, with ``text`` less its dropped lines, and the columns ``n_lines`` and ``n_dropped``.

    Texts meet their bitmaps by one exchange; a task holds the bitmaps of its share only.
    """
    found = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs).select(F.col("doc_id").alias("_hw_id"), F.col("text_hash").alias("_hw_hash"), F.col("keep").alias("_hw_keep"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.withColumns({"_hw_row": F.xxhash64(text)})
    met = hashed.join(found.hint("shuffle_hash"), hashed[id_col].eqNullSafe(found["_hw_id"]) & (hashed["_hw_row"] == found["_hw_hash"]), "left")
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    gone = F.aggregate(F.coalesce("_hw_keep", F.array().cast("array<struct<word:int,bits:bigint>>")), F.lit(0).cast("long"), lambda s, w: s + 64 - F.bit_count(w["bits"]))
    columns = [kept_text(text, F.col("_hw_keep")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return met.select(*columns, n_lines.cast("long").alias("n_lines"), gone.alias("n_dropped"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = """
WITH l AS (SELECT doc_id, rowid AS r, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM (SELECT *, row_number() OVER () AS rowid FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT doc_id, r, pos, line, last IS NULL OR doc_id = last AS stays FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256 FROM m GROUP BY doc_id, r
"""
