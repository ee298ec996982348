"""Host keys and evidence classes; the SQL names of the engine's functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from hostweave.functions import hashing, suffixes
from hostweave.functions.suffixes import SuffixRules

COHORTS = ("bidirectional", "in_only", "out_only", "isolated")
CONFIDENCES = ("high", "medium", "low")
STATES = ("active", "new", "reappeared", "missing")
OUTER_SPACE, OUTER_DOTS = r"^[\s\p{Z}]+|[\s\p{Z}]+$", r"^[.]+|[.]+$"

def forward_host(name: Column, reverse: bool = True) -> Column:
    """Trimmed, without outer dots, lower case; dot labels reversed if asked for."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(name, OUTER_SPACE, ""), OUTER_DOTS, ""))
    return F.array_join(F.reverse(F.split(bare, "[.]")), ".") if reverse else bare


host_key = forward_host


def evidence_cohort(in_degree: Column, out_degree: Column) -> Column:
    has_in, has_out = in_degree > 0, out_degree > 0
    return F.when(has_in & has_out, "bidirectional").when(has_in, "in_only").when(has_out, "out_only").otherwise("isolated")


def confidence_bucket(in_degree: Column, out_degree: Column) -> Column:
    both = (in_degree > 0).cast("int") + (out_degree > 0).cast("int")
    return F.element_at(F.array(*map(F.lit, reversed(CONFIDENCES))), both + 1)


def is_dangling(out_degree: Column) -> Column:
    return out_degree == 0


def register(spark: SparkSession, rules: SuffixRules | None = None) -> None:
    """SQL names: ``host_key(name)``, ``domain_key(host)``, ``split_bucket(eid, seed)``, ``evidence_cohort(i, o)``.

    They are the functions above in SQL; ``domain_key`` looks the suffixes up in the view
    ``hw_suffix_rules`` by one scalar subquery for each depth, which are planned as joins.
    """
    host = f"array_join(reverse(split(lower(regexp_replace(regexp_replace(name, r'{OUTER_SPACE}', ''), r'{OUTER_DOTS}', '')), '[.]')), '.')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION host_key(name STRING) RETURNS STRING RETURN {host}")
    suffixes.register(spark, rules)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION split_bucket(eid BIGINT, seed BIGINT) RETURNS INT RETURN CAST({hashing.sql_mod('(eid + seed)', hashing.BUCKETS)} AS INT)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION evidence_cohort(i BIGINT, o BIGINT) RETURNS STRING RETURN CASE WHEN i > 0 AND o > 0 THEN 'bidirectional' WHEN i > 0 THEN 'in_only' WHEN o > 0 THEN 'out_only' ELSE 'isolated' END")
