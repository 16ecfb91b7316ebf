"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.llm import packing, quality, repeats, simhash
from vellumflow.llm.common import table, written
from vellumflow.llm.queries import WORDS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the forest keep."""
    return quality.judged(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked at two differing bits or fewer."""
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents of smaller ids hold.

    Bytes go one by one; what is left of a character that was cut is a replacement character.
    """
    rows = repeats.dedup(docs).withColumn("text", repeats.valid_text("kept")).withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


# SQL cannot express a forest, fingerprints or a tokenizer; tests hold the result against plain Python.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
