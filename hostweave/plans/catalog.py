"""The registered queries over the derived host graph and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.functions import hashing, identity, suffixes
from hostweave.operators import contract, losses, neighbors, releases, split, training, vectors
from hostweave.operators import graph as g
from hostweave.plans import derived
from hostweave.plans.oracles import ORACLES
from hostweave.sources import export, scratch, shards, store
from hostweave.streaming import degrees as degree_stream
from hostweave.streaming import releases as release_stream

FLAGSHIP = "retention_ladder"
SLICE, SEED, CAP, WORLD, BATCH = 64, 42, 1000, 4, 512

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]


def degree_vector(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d, ordered=False).degrees()


def degree_totals(spark: SparkSession, d: str) -> DataFrame:
    return g.totals(degree_vector(spark, d))


def retention_ladder(spark: SparkSession, d: str) -> DataFrame:
    graph = derived.graph(spark, d, ordered=False)
    return g.retention_ladder(graph.degrees(), graph.edges)


def induced_edges(spark: SparkSession, d: str) -> DataFrame:
    graph = derived.graph(spark, d, ordered=False)
    return g.induced_edge_counts(graph.edges, graph.degrees())


def degree_histogram(spark: SparkSession, d: str) -> DataFrame:
    return g.degree_histogram(degree_vector(spark, d))


def min_degree_slice_edges(spark: SparkSession, d: str) -> DataFrame:
    return g.min_degree_slice(derived.graph(spark, d), SLICE)[0].edges


def min_degree_slice_nodes(spark: SparkSession, d: str) -> DataFrame:
    graph = derived.graph(spark, d, ordered=False)
    named = g.HostGraph(graph.edges, graph.num_nodes, derived.node_names(spark, d))
    return g.min_degree_slice(named, SLICE)[0].nodes.select("orig_id", "id", "name")


def endpoint_integrity(spark: SparkSession, d: str) -> DataFrame:
    ids = g.endpoints(derived.links(spark, d)).select(F.col("id").alias("orig_id"))
    vertices = derived.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return g.missing_nodes(ids, vertices)


def unique_endpoints(spark: SparkSession, d: str) -> DataFrame:
    return g.endpoints(derived.links(spark, d))


def to_undirected(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d, ordered=False).to_undirected().edges


def undirected_degrees(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d, ordered=False).to_undirected().degrees().select("id", "out_degree")


def adjacency_lists(spark: SparkSession, d: str) -> DataFrame:
    lists = derived.graph(spark, d).adjacency()
    return lists.select("id", F.col("offset").cast("long").alias("offset"), F.array_join(F.transform("neighbors", lambda x: x.cast("string")), ",").alias("neighbors"))


def adjacency_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour lists in rows of at most 16, so that most nodes have several."""
    rows = derived.graph(spark, d).adjacency_chunks(bound=16)
    return rows.select("id", "cell", "offset", F.size("neighbors").alias("n"), F.array_join(F.transform("neighbors", lambda x: x.cast("string")), ",").alias("neighbors"))


def adjacency_offsets(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d, ordered=False).adjacency_offsets(outgoing=False)


def neighbors_of(spark: SparkSession, d: str) -> DataFrame:
    graph = derived.graph(spark, d)
    out = graph.out_neighbors(7).select(F.lit("out").alias("direction"), "eid", "neighbor")
    return out.unionByName(graph.in_neighbors(7).select(F.lit("in").alias("direction"), "eid", "neighbor"))


def edge_mask_subgraph(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d).where_edges((F.col("src") + F.col("dst")) % 3 == 0).edges


def induced_prefix(spark: SparkSession, d: str) -> DataFrame:
    return derived.graph(spark, d).prefix(1000).compacted()[0].edges


def split_assignment(spark: SparkSession, d: str) -> DataFrame:
    return split.assigned(derived.edges(spark, d), SEED).select("eid", "bucket", "split")


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return split_assignment(spark, d).groupBy("split", "bucket").agg(F.count("*").alias("n"))


def split_eval_subsample(spark: SparkSession, d: str) -> DataFrame:
    edges = derived.edges(spark, d)
    return split.bounded(split.assigned(edges, SEED), edges.count(), SEED, CAP).where("split <> 'train'").select("eid", "split")


def subsample_exact(spark: SparkSession, d: str) -> DataFrame:
    return split.subsample(derived.edges(spark, d), CAP, SEED)


def permutation_split(spark: SparkSession, d: str) -> DataFrame:
    return split.permutation_split(derived.edges(spark, d), SEED).select("eid", "split")


def train_stripes(spark: SparkSession, d: str) -> DataFrame:
    parts = split.split_edges(derived.edges(spark, d), 0, SEED, CAP)
    return split.worker_stripes(parts, WORLD).groupBy("rank").agg(F.count("*").alias("n"), F.min("eid").alias("first_eid"), F.max("eid").alias("last_eid"))


def train_slices(spark: SparkSession, d: str) -> DataFrame:
    parts = split.split_edges(derived.edges(spark, d), 0, SEED, CAP)
    return split.worker_slices(parts, WORLD).groupBy("rank").agg(F.count("*").alias("n"), F.min("eid").alias("first_eid"), F.max("eid").alias("last_eid"))


def minibatch_local_index(spark: SparkSession, d: str) -> DataFrame:
    return split.minibatches(derived.edges(spark, d), BATCH, 1, SEED)


def uniform_negatives(spark: SparkSession, d: str) -> DataFrame:
    return training.uniform_negatives(derived.edges(spark, d), derived.num_nodes(spark, d), 5, SEED)


def host_keys(spark: SparkSession, d: str) -> DataFrame:
    return derived.reversed_hosts(spark, d).select("page_id", identity.host_key(F.col("name")).alias("host_key"))


def domain_keys(spark: SparkSession, d: str) -> DataFrame:
    return suffixes.with_domain(host_keys(spark, d).select("host_key").distinct())


def domain_keys_by_rules(spark: SparkSession, d: str) -> DataFrame:
    """Domains of hosts under suffixes of several labels, wildcards, exceptions, addresses and what no rule knows."""
    return suffixes.with_domain(derived.suffixed_hosts(spark, d))


def domain_key_sql(spark: SparkSession, d: str) -> DataFrame:
    """The same hosts by the SQL function."""
    identity.register(spark)
    derived.suffixed_hosts(spark, d).createOrReplaceTempView("hw_hosts")
    return spark.sql("SELECT domain_key(host_key) AS domain_key, count(*) AS n, min(page_id) AS first_id FROM hw_hosts GROUP BY 1")


def suffix_records(spark: SparkSession, d: str) -> DataFrame:
    """Host records whose names lie under suffixes of several labels."""
    ending = F.element_at(F.array(*[F.lit(".".join(reversed(e.split(".")))) for e in ("co.uk", "k12.ca.us", "ck", "city.kawasaki.jp", "com")]), (F.col("id") % 5 + 1).cast("int"))
    names = spark.range(derived.num_nodes(spark, d)).select("id", F.concat(ending, F.lit(".Shop"), (F.col("id") % 97).cast("string"), F.lit(".h"), F.col("id").cast("string")).alias("name"))
    return releases.records(names, degree_vector(spark, d)).select("host_key", "domain_key", "local_node_id", "cohort")


def host_records(spark: SparkSession, d: str) -> DataFrame:
    return releases.records(derived.node_names(spark, d), degree_vector(spark, d))


def cohort_counts(spark: SparkSession, d: str) -> DataFrame:
    return host_records(spark, d).groupBy("cohort", "confidence", "is_dangling").agg(F.count("*").alias("n"))


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = host_keys(spark, d).withColumnRenamed("page_id", "local_node_id")
    return releases.duplicate_keys(rows)


def _flat_index(index: DataFrame) -> DataFrame:
    entries = F.array_sort(F.transform(F.map_entries("local_node_ids"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))))
    return index.select("host_key", "first_release", "last_seen_release", "state", F.array_join(entries, ",").alias("local_ids"))


def cross_release_index(spark: SparkSession, d: str) -> DataFrame:
    return _flat_index(releases.release_index(derived.releases(spark, d)))


def streamed_release_index(spark: SparkSession, d: str) -> DataFrame:
    """The same index from releases that arrive one after the other, the second one last."""
    folder = scratch.new_path(spark, "arriving")
    found = derived.releases(spark, d)
    for i in (0, 2, 1):
        name, rows = found[i]
        rows.select("host_key", F.lit(i).alias("seq"), F.lit(name).alias("release"), F.col("local_node_id").cast("long").alias("local_node_id")).write.mode("append").parquet(f"{folder}/in")
        updates = release_stream.sightings(release_stream.release_stream(spark, f"{folder}/in", files=1 << 16))
        release_stream.stored_updates(updates, f"{folder}/updates", f"{folder}/checkpoint")  # goes on where it stopped
    return _flat_index(release_stream.as_of(spark.read.parquet(f"{folder}/updates"), 2))


def streamed_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Degrees of the nodes in edges, from edge files that arrive one after the other."""
    folder = scratch.new_path(spark, "edge-stream")
    derived.links(spark, d).select("src", "dst").repartition(3, "src").write.parquet(f"{folder}/in")
    running = degree_stream.running_degrees(degree_stream.edge_stream(spark, f"{folder}/in"))
    release_stream.stored_updates(running, f"{folder}/updates", f"{folder}/checkpoint")
    updates = spark.read.parquet(f"{folder}/updates")
    last = updates.groupBy("id").agg(F.max_by(F.struct("in_degree", "out_degree", "degree"), "batch").alias("x"))
    return last.select("id", "x.*")


def state_counts(spark: SparkSession, d: str) -> DataFrame:
    return releases.state_counts(releases.release_index(derived.releases(spark, d)))


def keys_reappeared(spark: SparkSession, d: str) -> DataFrame:
    return releases.keys_in_state(releases.release_index(derived.releases(spark, d)), "reappeared")


def normalize_vectors(spark: SparkSession, d: str) -> DataFrame:
    unit = derived.vectors(spark, d).select("id", vectors.normalized(F.col("embedding")).alias("v"))
    at = lambda i: F.round(F.element_at("v", i).cast("double"), 4)
    return unit.select("id", F.round(vectors.norm(F.col("v")), 4).alias("norm"), at(1).alias("x1"), at(64).alias("x64"))


def input_norms(spark: SparkSession, d: str) -> DataFrame:
    out = vectors.input_norms(derived.vectors(spark, d), id_col="id")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The nearest of every row whose id 50 divides, among all rows."""
    emb = derived.table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    out = neighbors.cosine_topk(emb, emb.where("id % 50 = 0"), 5)
    return out.select("query_id", "rank", "neighbor_id", F.round("cosine", 4).alias("cosine"))


def eval_ranks(spark: SparkSession, d: str) -> DataFrame:
    emb = derived.table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    n = emb.count()
    return vectors.ranked(derived.positives(spark, d, n), emb, n, 100, SEED)


def eval_mrr(spark: SparkSession, d: str) -> DataFrame:
    out = vectors.ranking_metrics(eval_ranks(spark, d))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def shard_ranges(spark: SparkSession, d: str) -> DataFrame:
    return export_shards(spark, d).where("kind = 'vectors'").select("shard", "row_start", "row_end", "n_rows")


def size_table(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the derived graph's release."""
    return contract.size_table(spark, derived.num_nodes(spark, d)).drop("vector_gib", "total_uncompressed_gib")


def schema_fields(spark: SparkSession, d: str) -> DataFrame:
    """The contract's places with the bytes that the derived graph's nodes take in each."""
    nodes = derived.num_nodes(spark, d)
    return contract.widths(spark).withColumnRenamed("place", "location").withColumn("all_nodes", F.col("bytes") * nodes)


def lr_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Learning rates of ten epochs over the derived training split, with the steps taken by the end of each."""
    config, edges = training.Config(epochs=10), split.assigned(derived.edges(spark, d), SEED)
    steps = edges.where("split = 'train'").agg(F.ceil(F.count("*") / BATCH).alias("steps"))
    rates = [F.struct(F.lit(e).alias("epoch"), F.lit(round(training.learning_rate(config, e), 9)).alias("lr")) for e in range(1, 11)]
    return steps.select("steps", F.explode(F.array(*rates)).alias("r")).select("r.epoch", "r.lr", (F.col("r.epoch") * F.col("steps")).alias("steps"))


def _batch_losses(spark: SparkSession, d: str) -> DataFrame:
    train = split.assigned(derived.edges(spark, d), SEED).where("split = 'train'")
    table = losses.initial_vectors(spark, derived.num_nodes(spark, d), 8, SEED)
    return losses.batch_losses(split.batched(train, BATCH, 1, SEED), table, 3, SEED)


def batch_losses(spark: SparkSession, d: str) -> DataFrame:
    """Losses of the starting vectors over the training split's mini-batches."""
    return _batch_losses(spark, d).withColumn("loss", F.round("loss", 6))


def epoch_loss(spark: SparkSession, d: str) -> DataFrame:
    """The mean of those, weighted by edges."""
    return losses.weighted_loss(_batch_losses(spark, d)).select(F.round("loss", 6).alias("loss"))


def initial_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Every node's starting vector."""
    rows = losses.initial_vectors(spark, derived.num_nodes(spark, d), 8, SEED)
    return rows.select("id", F.posexplode("embedding").alias("place", "x")).select("id", "place", F.round(F.col("x").cast("double"), 5).alias("x"))


def split_bucket_sql(spark: SparkSession, d: str) -> DataFrame:
    identity.register(spark)
    derived.edges(spark, d).createOrReplaceTempView("hw_edges")
    return spark.sql("SELECT split_bucket(eid, 42) AS bucket, count(*) AS n FROM hw_edges GROUP BY 1")


def hash_top_bits(spark: SparkSession, d: str) -> DataFrame:
    """Every edge's hash at ordinals of web scale."""
    rows = derived.edges(spark, d).select((F.col("eid") + 13_070_000_000).alias("eid"))
    return rows.select("eid", hashing.top24(F.col("eid"), SEED).alias("top24"), hashing.split_bucket(F.col("eid"), SEED).alias("bucket"))


def train_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Trains on the derived graph's training split; the final table's shape and its history."""
    parts = split.split_edges(derived.edges(spark, d), derived.num_nodes(spark, d), SEED, CAP)
    config = training.Config(dim=16, epochs=2, batch=1024, eval_neg=20)
    table, history = training.train_embeddings(parts.part("train"), parts.num_nodes, config, scratch.new_path(spark, "train"), parts.part("val"))
    rows = table.agg(F.count("*").alias("n_nodes"), F.max(F.size("embedding")).alias("dim"))
    return rows.withColumn("loss_fell", F.lit(history[-1]["loss"] < history[0]["loss"]))


def export_shards(spark: SparkSession, d: str) -> DataFrame:
    """Exports all vectors in both tiers; a row per file, with what reading it again shows."""
    emb = derived.vectors(spark, d).withColumnRenamed("id", "row_id")
    names = emb.select("row_id", F.concat(F.lit("com.h"), F.col("row_id").cast("string")).alias("name"))
    folder = scratch.new_path(spark, "export")
    made = export.export_shards(emb, names, folder, "rel-1", "crawl-1", "space-1", rows_per_shard=200)
    entries = spark.createDataFrame([tuple(e[f.split()[0]] for f in export.ENTRY.split(", ")) for e in made["shards"]], export.ENTRY)
    files = spark.read.format("binaryFile").load([f"{folder}/{kind}" for kind in made["precisions"]])
    stored = files.select(F.substring_index("path", "/", -2).alias("filename"), F.sha2("content", 256).alias("digest"), F.col("length").alias("size"))
    told = entries.join(stored, "filename").select("kind", "shard", "filename", "row_start", "row_end", "n_rows", ((F.col("digest") == F.col("sha256")) & (F.col("size") == F.col("bytes"))).alias("intact"))
    rows = spark.read.parquet(f"{folder}/vectors").groupBy(F.floor(F.col("row_id") / 200).alias("shard")).agg(F.min("host_key").alias("least_host"), F.count_distinct("domain_key").alias("domains"), F.round(F.sum(vectors.norm(F.col("embedding"))), 3).alias("norms"))
    return told.join(rows, "shard")


def graph_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The derived graph as it is read from where it was stored."""
    folder = scratch.new_path(spark, "graph")
    store.save_graph(derived.graph(spark, d), folder)
    return store.load_graph(spark, folder).edges


def stored_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Degrees over the derived graph as it is stored by both ends."""
    folder = scratch.new_path(spark, "buckets")
    store.save_graph(derived.graph(spark, d), folder, buckets=8)
    return store.load_graph(spark, folder).degrees()


def worker_slice(spark: SparkSession, d: str) -> DataFrame:
    """The third of four workers' edges, by a range of ordinals of the stored split."""
    folder = scratch.new_path(spark, "split")
    store.save_split(split.split_edges(derived.edges(spark, d), derived.num_nodes(spark, d), SEED, CAP), folder)
    return split.worker_slice(store.load_split(spark, folder), WORLD, 2).select("eid", "train_ordinal")


def split_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Splits and training ordinals as they are read from where they were stored."""
    folder = scratch.new_path(spark, "split")
    store.save_split(split.split_edges(derived.edges(spark, d), derived.num_nodes(spark, d), SEED, CAP), folder)
    return store.load_split(spark, folder).edges.select("eid", "split", "train_ordinal")


def _edge_shards(spark: SparkSession, d: str, sep: str = "\t", compression: str = "gzip") -> str:
    """The derived edges as two text shards, or more if there are many, in order of their ordinals."""
    folder = scratch.new_path(spark, "edge-shards")
    shards.write_lines(derived.edges(spark, d), folder, "eid", F.concat_ws(sep, "src", "dst"), 2, compression)
    return folder


def shard_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges as they are read, with their ordinals, from compressed shards."""
    return shards.read_edges(spark, _edge_shards(spark, d))


def shard_edges_lenient(spark: SparkSession, d: str) -> DataFrame:
    """The first 1000 edges of plain shards with any white space between fields."""
    return shards.read_edges(spark, _edge_shards(spark, d, " \t ", "none"), lenient=True, max_edges=1000)


def shard_slice_names(spark: SparkSession, d: str) -> DataFrame:
    """The kept nodes' names, edges and names alike read from shards."""
    folder = scratch.new_path(spark, "vertex-shards")
    shards.write_lines(derived.node_names(spark, d), folder, "id", F.concat_ws("\t", "id", "name"))
    full = g.HostGraph(shards.read_edges(spark, _edge_shards(spark, d)), shards.count_lines(spark, folder), shards.read_vertices(spark, folder))
    return g.min_degree_slice(full, SLICE)[0].nodes.select("orig_id", "id", "name")


QUERIES = {
    f.__name__: f
    for f in (
        degree_vector, degree_totals, retention_ladder, induced_edges, degree_histogram, min_degree_slice_edges, min_degree_slice_nodes,
        endpoint_integrity, unique_endpoints, to_undirected, undirected_degrees, adjacency_lists, adjacency_chunks, adjacency_offsets, neighbors_of, edge_mask_subgraph,
        induced_prefix, split_assignment, split_counts, split_eval_subsample, subsample_exact, permutation_split, train_stripes, train_slices,
        minibatch_local_index, uniform_negatives, host_keys, domain_keys, domain_keys_by_rules, domain_key_sql, suffix_records, host_records, cohort_counts, duplicate_keys, cross_release_index,
        streamed_release_index, streamed_degrees,
        state_counts, keys_reappeared, normalize_vectors, input_norms, cosine_topk, eval_ranks, eval_mrr, shard_ranges, size_table,
        graph_round_trip, split_round_trip, stored_degrees, worker_slice, schema_fields, lr_schedule, split_bucket_sql, hash_top_bits, train_embeddings, export_shards,
        shard_edges, shard_edges_lenient, shard_slice_names, batch_losses, epoch_loss, initial_vectors,
    )
}
#: Earlier names of queries over whole tables.
QUERIES |= {"uniform_negatives_all": uniform_negatives, "input_norms_leading": input_norms, "cosine_topk_all": cosine_topk}
