"""Corpus pipeline: documents to a mixed, tokenised training set.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``;
:func:`run` writes each result as Parquet under the shared folder and hands the
written table to the next stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, hyperminhash, source_mix, token_output, toxicity
from wardflow.llm.common import table
from wardflow.session import ensure_checkpoint_dir

# SQL cannot express the trained toxicity scores or the coder; the stages are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold (fitted on labels outside the held-out fold);
    all of them where the labels are too few for a classifier."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if model.trees is None:
        return docs
    scored = model.score(docs, docs.columns, "__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return hyperminhash.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: whole repeats of documents, and one cut document per source where its budget ends."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__row"))
    rows = source_mix.mixed_rows(source_mix.mix_sources(packed), ["text", "__cut", "__row"])
    own = {"text": F.col("text"), "n_chars": F.when(F.col("__cut").isNotNull(), F.length("text").cast("long")).otherwise(F.col("__row.n_chars"))}
    return rows.select(*[own.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every row's ids in the token file."""
    import public_tokenizers
    return token_output.token_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("source_mix", mix), ("token_output", write_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = ensure_checkpoint_dir(spark).rstrip("/")
    for name, stage in STAGES:
        path = f"{base}/wardflow-pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
