"""URL filters: host rules, and association rules mined from labelled URLs.

A URL becomes a set of tokens (host labels, path words with digits masked, query keys).
Spark's FP-growth mines the token combinations of labelled URLs together with their
label; of the rules that predict blocking, those of enough support and confidence stay,
and of these only rules that no sub-combination predicts at least as confidently. A
URL's rules are found by an inverted index: each rule is posted under its rarest token,
a token set looks up its tokens and verifies the rule's others.

Host rules come first: a rule fits its host and all subdomains where the path starts
with the rule's path; the longest rule wins. Where none fits, a mined rule blocks, and
everything else is allowed.

Defined results: a null URL or one without ``://`` has an empty host and path and no
token, fits no rule and is allowed; a null page_id is kept; repeated rows repeat, and count
as often when rules are mined; very long URLs are read whole; of mined rules that fit, the
one of highest confidence, then support, then name is told; without labelled URLs nothing
is mined; an empty table gives an empty result; extra columns are not read. Token sets are
judged once each, however many pages share one.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"
#: The contract's host rules: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Sorted, distinct tokens of a URL."""
    words = lambda prefix, items: F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), F.regexp_replace(F.lower(x), "[0-9]+", "0")))
    query = F.coalesce(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.split(query, "[&;]"), lambda x: F.element_at(F.split(x, "="), 1))
    return F.array_sort(F.array_distinct(F.concat(words("h:", F.split(host(url), r"\.")), words("p:", F.split(path(url), "[/._-]")), words("q:", keys))))


def host_rule(host_col: Column, path_col: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest fitting rule as a struct ``(length, rule, verdict)``, or null."""
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    table = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in rules])
    fits = F.filter(table, lambda r: ((host_col == r["host"]) | host_col.endswith(F.concat(F.lit("."), r["host"]))) & path_col.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["length"].alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def mine(sets: DataFrame, support: float = 0.002, confidence: float = 0.6, least: int = 10) -> DataFrame:
    """``(antecedent, confidence, support)`` of blocking rules from ``(tokens, block)``.

    A rule needs the relative support and at least ``least`` labelled URLs, the
    confidence, a lift over 1, and no part of it may predict as confidently.
    """
    spark = sets.sparkSession
    items = cut(sets.where(F.size("tokens") > 0).select(F.when(F.col("block"), F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items")), "transactions")
    n = items.count()
    kind = "antecedent array<string>, confidence double, support double"
    if not n:
        return spark.createDataFrame([], kind)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, least / n)), minConfidence=confidence).fit(items)
    rules = cut(model.associationRules.where((F.element_at("consequent", 1) == BLOCK) & (F.coalesce(F.col("lift"), F.lit(2.0)) > 1)).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "rules")
    parts = rules.select("antecedent", "confidence", "support", F.explode("antecedent").alias("token"))
    part = rules.select(F.col("antecedent").alias("inner"), F.col("confidence").alias("inner_confidence"), F.element_at("antecedent", 1).alias("token"))
    beaten = parts.join(part, "token").where((F.size("inner") < F.size("antecedent")) & (F.size(F.array_except("inner", "antecedent")) == 0) & (F.col("inner_confidence") >= F.col("confidence"))).select("antecedent").distinct()
    return rules.join(beaten, "antecedent", "left_anti")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``(tokens, mined, confidence)``: the best rule of each distinct token set that has one."""
    distinct = cut(sets.select("tokens").distinct(), "token-sets")
    posted = distinct.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    spread = rules.select("antecedent", "confidence", "support", F.explode("antecedent").alias("token")).join(posted, "token", "left")
    index = spread.groupBy("antecedent", "confidence", "support").agg(F.min_by("token", F.struct(F.coalesce("df", F.lit(0)), F.col("token"))).alias("token"))
    hits = distinct.select("tokens", F.explode("tokens").alias("token")).join(index, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.struct("confidence", "support", F.array_join("antecedent", " & ").alias("rule"))
    return hits.groupBy("tokens").agg(F.max(best).alias("b")).select("tokens", F.col("b.rule").alias("mined"), F.col("b.confidence").alias("confidence"))


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined, confidence)`` for every row.

    ``labels`` is ``(doc_id, quality, toxic)``; a URL is labelled by the number that its
    last all-digit path word names, and counts as blocked if that document is of low
    quality or toxic.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"), F.regexp_extract(path(url), r"^.*[/._-](\d{1,18})(?:[/._-]|$)", 1).try_cast("long").alias("doc"))
    marks = labels.groupBy(F.col("doc_id").alias("doc")).agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("block"))
    learnt = rows.where(F.col("doc").isNotNull()).join(marks, "doc").select("tokens", "block")
    found = matched(rows, mine(learnt))
    ruled = rows.select("page_id", "host", "path", "tokens", host_rule(F.col("host"), F.col("path"), rules).alias("r")).join(found, "tokens", "left")
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "mined", "confidence")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
