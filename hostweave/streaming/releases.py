"""Lifecycles of hosts over releases as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.operators.releases import lifecycle

ARRIVAL = "host_key string, seq int, release string, local_node_id long"


def release_stream(spark: SparkSession, folder: str, files: int = 1) -> DataFrame:
    """Rows of releases from Parquet files as they arrive: host, place in time, name and local id."""
    return spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", files).parquet(folder)


def sightings(arrivals: DataFrame) -> DataFrame:
    """``(host_key, seqs, names, locals)``: all releases of a host so far, for each host that arrives.

    The state of a host is one short list, in order of releases, whatever order they arrive
    in; a release that comes again replaces itself (within one micro-batch, the greatest
    row of a release counts). Rows bear their micro-batch's time to tell which came last.
    Output mode is ``update``. It is a native aggregation, so no
    host costs a call of Python.
    """
    row = F.struct("seq", "_hw_at", "release", "local_node_id")
    kept = arrivals.withColumn("_hw_at", F.current_timestamp()).groupBy("host_key").agg(F.array_sort(F.collect_set(row)).alias("x"))
    last = F.filter("x", lambda r, i: F.coalesce(F.get(F.col("x"), i + 1)["seq"] != r["seq"], F.lit(True)))
    of = lambda name: F.transform("last", lambda r: r[name])
    return kept.select("host_key", last.alias("last")).select("host_key", of("seq").alias("seqs"), of("release").alias("names"), of("local_node_id").alias("locals"))


def stored_updates(updates: DataFrame, folder: str, checkpoint: str) -> None:
    """Runs over all that has arrived and keeps each batch's updates as a table of its own, so a repeated batch replaces itself."""

    def keep(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    query = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()


def as_of(updates: DataFrame, latest: int) -> DataFrame:
    """The index that joins all releases up to the latest one, from the updates: each host's last."""
    seen = updates.groupBy("host_key").agg(F.max_by(F.struct("seqs", "names", "locals"), "batch").alias("x")).select("host_key", "x.*")
    has = lambda s: F.array_contains("seqs", s)
    state = lifecycle(has(latest), has(latest - 1), F.exists("seqs", lambda s: s < latest))
    ids = F.map_from_arrays("names", "locals")
    return seen.select("host_key", F.element_at("names", 1).alias("first_release"), F.element_at("names", -1).alias("last_seen_release"), state.alias("state"), ids.alias("local_node_ids"))
