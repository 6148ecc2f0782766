"""Corpus preparation in stages, each written as Parquet and read again by the next, after which its files go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import jaccard_tgm, langid_ftrl, pfair, quality_mcd, sp_scan
from stallwise.llm.common import crc_of_id
from stallwise.session import discard, durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_mcd.filtered(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with a probability of at least one half."""
    model = langid_ftrl.train(docs, crc_of_id() % 5 != 0)
    return langid_ftrl.told(docs, model, least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of a similarity of 0.8 or more."""
    return jaccard_tgm.first_of_each(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot and position in the mixed order of the sources, which files and rows follow."""
    return pfair.in_order(docs, places=True)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, place in the mixed order and token ids of every document."""
    return sp_scan.encoded(docs, sp_scan.load()).select("doc_id", "lang", "source", "slot", "position", "ids", F.size("ids").alias("n_ids"))


STAGES = [
    ("quality rules", quality),
    ("language identification", language),
    ("near duplicates", near_duplicates),
    ("source mixing", mixing),
    ("token ids", encoding),
]

# Robust estimates, trained models and schedules are beyond SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows in the mixed order; ``position`` counts them from 0."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs.orderBy("position")
