"""Release manifests of hosts and the index that joins successive releases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostweave.functions.identity import confidence_bucket, evidence_cohort, forward_host, is_dangling
from hostweave.functions.suffixes import SuffixRules, with_domain

RECORD = ("host_key", "domain_key", "local_node_id", "in_degree", "out_degree", "is_dangling", "cohort", "confidence")


def duplicate_keys(records: DataFrame, key: str = "host_key") -> DataFrame:
    """Keys that occur more than once, with their least and greatest local ids."""
    return records.groupBy(key).agg(F.count("*").alias("n"), F.min("local_node_id").alias("first_id"), F.max("local_node_id").alias("last_id")).where("n > 1")


def records(nodes: DataFrame, degree: DataFrame, reverse: bool = True, check: bool = True, rules: SuffixRules | None = None) -> DataFrame:
    """Host records from ``nodes(id, name)`` and degrees; a repeated key is an error.

    Domain keys follow ``rules``, or else the list that Spark's libraries carry.
    """
    named = nodes.select("id", forward_host(F.col("name"), reverse).alias("host_key"))
    out = with_domain(named, rules).join(degree, "id").select(
        "host_key",
        "domain_key",
        F.col("id").alias("local_node_id"),
        "in_degree",
        "out_degree",
        is_dangling(F.col("out_degree")).cast("int").alias("is_dangling"),
        evidence_cohort(F.col("in_degree"), F.col("out_degree")).alias("cohort"),
        confidence_bucket(F.col("in_degree"), F.col("out_degree")).alias("confidence"),
    )
    if check and (twice := duplicate_keys(named.select("host_key", F.col("id").alias("local_node_id"))).first()):
        raise ValueError(f"duplicate host key {twice['host_key']!r}: nodes {twice['first_id']} and {twice['last_id']}")
    return out


def check_crawls(crawls: list[str] | str) -> list[str]:
    """One to three crawl ids make a release; one text lists them with commas between."""
    crawls = crawls.split(",") if isinstance(crawls, str) else crawls
    crawls = [c.strip() for c in crawls if c.strip()]
    if not 1 <= len(crawls) <= 3:
        raise ValueError(f"a release has 1 to 3 source crawls, not {len(crawls)}")
    return crawls


def lifecycle(in_latest: Column, in_previous: Column, in_earlier: Column) -> Column:
    """State of a key as of the latest release; ``in_earlier`` is: in any but the latest."""
    return F.when(~in_latest, "missing").when(in_previous, "active").when(in_earlier, "reappeared").otherwise("new")


def release_index(releases: list[tuple[str, DataFrame]]) -> DataFrame:
    """Joins releases, oldest first, on ``host_key``.

    ``(host_key, first_release, last_seen_release, state, local_node_ids)``. A union and
    one aggregation replace the full outer joins; the aggregation combines before it
    shuffles.
    """
    names = [name for name, _ in releases]
    if not names:
        raise ValueError("at least one release is needed")
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate release ids: {names}")
    latest = len(names) - 1
    rows = reduce(DataFrame.unionByName, [df.select("host_key", F.lit(i).alias("seq"), F.lit(name).alias("release"), F.col("local_node_id").cast("long").alias("local")) for i, (name, df) in enumerate(releases)])
    seen = lambda i: F.max(F.col("seq") == i) if i >= 0 else F.lit(False)
    grouped = rows.groupBy("host_key").agg(
        F.min_by("release", "seq").alias("first_release"),
        F.max_by("release", "seq").alias("last_seen_release"),
        lifecycle(seen(latest), seen(latest - 1), F.max(F.col("seq") < latest)).alias("state"),
        F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("seq", "release", "local"))), lambda x: F.struct(x["release"], x["local"]))).alias("local_node_ids"),
    )
    return grouped


def state_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("state").agg(F.count("*").alias("n"))


def keys_in_state(index: DataFrame, state: str) -> DataFrame:
    return index.where(F.col("state") == state).select("host_key")
