"""A training-data pipeline over ``documents``, as stages that each write Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.llm import bpe, decontaminate, langid, quality, simhash
from vintagelake.llm.common import MADE, drop_made_since, stage, table, without_ids
from vintagelake.llm.queries import WORD_BPE


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the bounds of their language's trusted ones."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return without_ids(docs, judged.where(~F.col("keep")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")  # whatever the columns' names
    predicted = langid.predict(rows, langid.fit(docs))
    return predicted.where("recognised").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    classes = stage(simhash.near_duplicates(docs, shingle=3, bits=2).select("doc_id", "component_id"), "classes")
    kept = without_ids(docs, classes.where("doc_id <> component_id"))
    if not classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        unnamed = kept.where("doc_id IS NULL")  # rows that share an id are one document
        kept = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).union(unnamed)
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows do not cover a twentieth of the words or more."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), width=13)
    return without_ids(docs, found.where(decontaminate.is_contaminated()))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids (little-endian unsigned 32-bit) and their decoded text, of every kept document."""
    return bpe.encode_documents(docs, WORD_BPE).select("doc_id", "lang", "source", "n_tokens", "ids", "decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again, and
    what it and the stage before it had staged is then deleted."""
    docs, first = table(spark, sf_dir, "documents"), len(MADE)
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
            drop_made_since(spark, first, keep=docs)
    return docs
