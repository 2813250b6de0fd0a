"""A corpus from the documents table: without toxic texts and copies, without personal data, packed into token sequences."""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import exact, packing, pii, simhash, toxicity
from placeforge.llm.common import shared_dir, table

#: What Spark hands to Python at once; the session's own value holds where it has one. With Spark's 64 MB a whole split of documents is one
#: batch, of which the executor and each of its Python workers hold copies.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(stage):
    """The stage, with documents handed to Python by BATCH_BYTES."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH, spark.conf.get(BATCH, BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones, rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


@small_batches
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact.deduplicate(docs)


@small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that hang together by a similarity of 0.8 the one with the smallest doc_id stays."""
    return simhash.deduplicate(docs)


@small_batches
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; n_chars follows the new text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


@small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its ids' place in a sequence of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("simhash near-dedup", drop_near_copies), ("pii", hide_personal_data), ("packing", pack)]

#: SQL has neither the model's training nor fingerprint links nor packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; each result is written as Parquet in the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/stage{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
