"""Registrable domains by all rules of the public suffix list, as joins that Catalyst plans.

The list is a table ``(suffix, kind)``; ``kind`` adds up 1 (the suffix itself is public),
2 (whatever label stands before it makes a public suffix, ``*.``) and 4 (an exception,
``!``). A host is looked up once at each depth, from its last label to the deepest rule;
its public suffix is the longest that a rule gives, unless an exception says otherwise.
Rules are few, so their side is broadcast, once for all depths, and hosts aren't moved.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where Spark's own libraries carry the list (the Mozilla Foundation's, publicsuffix.org).
RESOURCE = "mozilla/public-suffix-list.txt"
BEGIN, END = "===BEGIN ICANN DOMAINS===", "===END ICANN DOMAINS==="
PUBLIC, WILDCARD, EXCEPTION = 1, 2, 4
#: A table of more rules than this is left to the optimiser instead of broadcast.
BROADCAST_RULES = 1 << 17
VIEW = "hw_suffix_rules"


@dataclass(frozen=True)
class SuffixRules:
    """``table(suffix, kind)`` and the labels of the longest suffix that a rule names."""

    table: DataFrame
    depth: int
    count: int


def listed_text(spark: SparkSession) -> str:
    """The newest list on Spark's class path."""
    found = spark.sparkContext._jvm.Thread.currentThread().getContextClassLoader().getResources(RESOURCE)
    texts = []
    while found.hasMoreElements():
        stream = found.nextElement().openStream()
        try:
            texts.append(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
    if not texts:
        raise FileNotFoundError(f"no {RESOURCE} on the class path; name a file in its format")
    return max(texts, key=len)


@functools.lru_cache(4)
def parsed(text: str) -> dict[str, int]:
    """Suffix to kind, of the ICANN part; labels beyond ASCII also as hosts spell them."""
    if BEGIN in text:
        text = text.split(BEGIN, 1)[1].split(END, 1)[0]
    rules: dict[str, int] = {}
    for line in text.splitlines():
        word = line.split()[0] if line.strip() and not line.startswith("//") else ""
        kind = EXCEPTION if word.startswith("!") else WILDCARD if word.startswith("*.") else PUBLIC
        name = word.removeprefix("!").removeprefix("*.").lower()
        for form in {name, name if name.isascii() else name.encode("idna").decode()} if name else ():
            rules[form] = rules.get(form, 0) | kind
    return rules


def suffix_rules(spark: SparkSession, path: str | None = None) -> SuffixRules:
    """The rules of a file in the list's format, in any store that Spark reads, or else of Spark's own copy."""
    text = listed_text(spark) if path is None else "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    rules = parsed(text)
    if not rules:
        raise ValueError(f"no suffix rule in {path or RESOURCE}")
    return SuffixRules(spark.createDataFrame(sorted(rules.items()), "suffix string, kind int"), max(s.count(".") + 1 for s in rules), len(rules))


def last_labels(host: str, n: int) -> str:
    """SQL: the last ``n`` labels of a host that has so many, else null."""
    return f"if(size(split({host}, '[.]')) >= {n}, substring_index({host}, '.', -{n}), NULL)"


def suffix_length(host: str, kinds: list[str]) -> str:
    """SQL: how many labels the public suffix has (0: no rule fits), from what the rules say at depth 1, 2, ..."""
    says = lambda i, kind: f"coalesce({kinds[i]} & {kind}, 0) > 0"
    exceptions = " ".join(f"WHEN {says(i, EXCEPTION)} THEN {i}" for i in reversed(range(len(kinds))))
    public = [f"if({says(i, PUBLIC)}, {i + 1}, 0)" for i in range(len(kinds))]
    wildcards = [f"if({says(i, WILDCARD)} AND size(split({host}, '[.]')) > {i + 1}, {i + 2}, 0)" for i in range(len(kinds))]
    return f"CASE {exceptions} ELSE greatest({', '.join(public + wildcards)}) END"


def domain_of(host: str, length: str) -> str:
    """SQL: the public suffix and the label before it.

    A host that is itself a public suffix, has an empty label before it, or ends in
    nothing that a rule knows (an address, say) is its own domain.
    """
    return f"CASE WHEN {length} = 0 OR size(split({host}, '[.]')) <= {length} OR element_at(split({host}, '[.]'), -1 - {length}) = '' THEN {host} ELSE substring_index({host}, '.', -1 - {length}) END"


def with_domain(hosts: DataFrame, rules: SuffixRules | None = None, host: str = "host_key", name: str = "domain_key") -> DataFrame:
    """Adds the registrable domain of a column of forward hosts (null stays null)."""
    rules = suffix_rules(hosts.sparkSession) if rules is None else rules
    table = F.broadcast(rules.table) if rules.count <= BROADCAST_RULES else rules.table
    kinds = [f"_hw_kind_{d}" for d in range(1, rules.depth + 1)]
    out = hosts
    for d, kind in enumerate(kinds, 1):
        at = table.select(F.col("suffix").alias(f"_hw_suffix_{d}"), F.col("kind").alias(kind))
        out = out.join(at, F.expr(last_labels(f"`{host}`", d)) == F.col(f"_hw_suffix_{d}"), "left").drop(f"_hw_suffix_{d}")
    out = out.withColumn("_hw_length", F.expr(suffix_length(f"`{host}`", kinds)))
    return out.select(*hosts.columns, F.expr(domain_of(f"`{host}`", "_hw_length")).alias(name))


def register(spark: SparkSession, rules: SuffixRules | None = None) -> None:
    """The SQL function ``domain_key(host)`` over the view of the rules."""
    rules = suffix_rules(spark) if rules is None else rules
    rules.table.createOrReplaceTempView(VIEW)
    kinds = [f"(SELECT max(kind) FROM {VIEW} WHERE suffix = {last_labels('host', d)})" for d in range(1, rules.depth + 1)]
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION domain_of_length(host STRING, n INT) RETURNS STRING RETURN {domain_of('host', 'n')}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION domain_key(host STRING) RETURNS STRING RETURN domain_of_length(host, {suffix_length('host', kinds)})")
