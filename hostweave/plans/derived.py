"""The graph, names, vectors and releases derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.functions.identity import host_key
from hostweave.operators.graph import HostGraph
from hostweave.operators.ordinals import tasks_for, with_ordinal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def num_nodes(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "customer").count() + table(spark, sf_dir, "part").count()


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer to part, one link for each line item; no ordinals. Large tables are joined in more tasks."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    tasks = tasks_for(spark, items.count())
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        items, orders = (rows.repartition(tasks, "l_orderkey") for rows in (items, orders))
    return items.join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(eid, src, dst)`` with ordinals by order, part and line."""
    return with_ordinal(links(spark, sf_dir), ["l_orderkey", "dst", "l_linenumber"], "eid", rows=table(spark, sf_dir, "lineitem").count()).select("eid", "src", "dst")


def graph(spark: SparkSession, sf_dir: str, ordered: bool = True) -> HostGraph:
    """``ordered=False`` for work in which edge ordinals play no part."""
    found = edges(spark, sf_dir) if ordered else links(spark, sf_dir).select(F.lit(0).cast("long").alias("eid"), "src", "dst")
    return HostGraph(found, num_nodes(spark, sf_dir), about=table(spark, sf_dir, "lineitem").count())


def reversed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, name)``: hosts of page URLs in reversed notation."""
    host = F.lower(F.regexp_extract("url", r"^https?://([^/?#]*)", 1))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.reverse(F.split(host, "[.]")), ".").alias("name"))


def node_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, name)`` for every node: a reversed host made of its number."""
    label = F.concat(F.lit("com.site"), (F.col("id") % 97).cast("string"), F.lit(".H"), F.col("id").cast("string"))
    return spark.range(num_nodes(spark, sf_dir)).select("id", label.alias("name"))


#: Ends of host names, by which rules of every kind come up; ``#`` stands for the row's number.
ENDINGS = (
    "com", "co.uk", "k12.ca.us", "ck", "www.ck", "nsw.edu.au", "kawasaki.jp", "city.kawasaki.jp", "xn--55qx5d.cn", "nosuchdomain", "10.0.#", "=co.uk", "=ck", "=jp", "=www.ck",
)


def suffixed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, host_key)``: each page as a host under one of the endings; after ``=`` it stands for the whole host."""
    n = F.col("page_id").cast("string")
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (F.col("page_id") % len(ENDINGS) + 1).cast("int"))
    whole = F.when(ending.startswith("="), F.substring(ending, 2, 99)).when(ending.endswith("#"), F.concat(F.lit("10.0."), n, F.lit(".7"))).otherwise(F.concat(F.lit("www.h"), n, F.lit("."), ending))
    return table(spark, sf_dir, "pages").select("page_id", whole.alias("host_key"))


def second_level(host: Column) -> Column:
    return F.array_join(F.slice(F.split(host, "[.]"), -2, 2), ".")


def releases(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Three releases: customers not divisible by 3, 4 and 5, numbered anew in each."""
    names = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("com.c"), F.col("c_custkey").cast("string")).alias("name"))
    out = []
    for i, k in enumerate((3, 4, 5), start=1):
        kept = names.where(F.col("c_custkey") % k != 0).withColumn("order", F.col("c_custkey") if i != 2 else -F.col("c_custkey"))
        out.append((f"rel-{i}", with_ordinal(kept, ["order"], "local_node_id").select(host_key(F.col("name")).alias("host_key"), "local_node_id")))
    return out


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, embedding)`` of changed lengths, so that normalising shows; every 50th is zero."""
    scale = F.when(F.col("vec_id") % 50 == 49, 0.0).otherwise(1.0 + F.col("vec_id") % 7)
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: (x.cast("double") * scale).cast("float")).alias("embedding"))


def positives(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``(eid, src, dst)``: each vector and another, by arithmetic on ids."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("eid"), F.col("vec_id").alias("src"), ((F.col("vec_id") * 7 + 3) % n).alias("dst"))
