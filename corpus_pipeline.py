"""The corpus pipeline over ``documents``.

Each stage is a function of ``(spark, docs, sf_dir)`` that returns a DataFrame; between
stages the rows are written as Parquet and read again. Stages work on all rows that the
one before kept; all but the last return the columns of ``documents``.

Defined results, in every stage: a null text is the empty text (it has no language, so the
first stage drops it); a null id or source is a value like others; very long texts are
read whole; rows alike become one in the second stage, where ties go to the least id; an
empty table gives an empty result; further columns, whatever their names, pass through up
to the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm import langid, packing, secrets, simhash
from hostweave.llm.common import cut


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is found; those without a letter, or torn between languages, go."""
    import public_tokenizers

    model = langid.train(docs, langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model")), F.lit(True))
    return langid.identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with secrets masked."""
    return secrets.redacted(docs, secrets.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.packed(docs)


STAGES = [("language", find_language), ("near_dedup", drop_near_copies), ("secrets", mask_secrets), ("packing", pack)]

#: Learned models and hashes aren't expressible in the oracle's SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs, f"stage-{name}")
    return docs
