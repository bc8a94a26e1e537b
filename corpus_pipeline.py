"""The corpus pipeline: documents through five operators of quillgraph.llm, each stage working on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import mixing, neardup, repeats, subwords, toxicity
from quillgraph.llm.common import drop, durable, passing


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep(docs, toxicity.fit(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return neardup.deduplicate(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated passages are cut out of the texts; every document stays."""
    return repeats.rewrite(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as their source's target takes them."""
    return mixing.materialise(docs, mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids of each text of the mix."""
    return subwords.encode(docs)


STAGES = [("toxicity", clean), ("near-duplicates", distinct), ("repeated passages", unrepeated), ("mixing", mixed), ("subwords", encoded)]

#: The stages hold a trained model and a public vocabulary, which SQL can't express; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with passing() as keep:  # what a stage wrote on its way goes once its result is written, and so does the result before it
            docs = keep(durable(stage(spark, docs, sf_dir)))
        if before:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
