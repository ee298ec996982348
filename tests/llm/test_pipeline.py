from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_models import brute_spans


def test_stages_take_effect(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = source.unionByName(source.where("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 9000))
    extra = spark.createDataFrame([(8000, None, None, None, None), (8001, "123 456", "en", "src1", 7), (8002, 'Nothing here. password = "hunter2secret" so it is, that the of and to in was', "en", "src1", 70)], source.schema)
    docs = docs.unionByName(extra)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "packing":
            assert out.columns == source.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert kept["language"] == {r["doc_id"] for r in source.collect()} | {9000, 9001, 9002, 8002}
    assert {0, 1, 2, 8002} <= kept["near_dedup"] and not {9000, 9001, 9002} & kept["near_dedup"]
    texts = source.groupBy("text").agg(F.min("doc_id").alias("i"), F.count("*").alias("n")).where("n > 1").collect()
    assert all(r["i"] in kept["near_dedup"] for r in texts)
    assert kept["secrets"] == kept["near_dedup"] == kept["packing"]
    masked = spark.read.parquet(f"{tmp_path}/secrets").collect()
    assert all(not brute_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in masked)
    assert "[SECRET]" in next(r["text"] for r in masked if r["doc_id"] == 8002)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
