"""A corpus pipeline over documents: language, toxicity, near-duplicates, personal data, packing.

Each stage works on all rows that the one before kept, and is written as Parquet and read
again for the next. The first four return the columns of documents; the last
returns where each piece of each document went. As soon as a stage is written, the tables that it made on its way
and its input are deleted, so no more than one stage's are on disk.

Defined results: each stage keeps nulls in any column, the columns of its input whatever their names, and texts of
any length; a null text counts as an empty one; an empty table stays empty; repeated rows share their fate, of which the third stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomere.llm import langid, packing, pii, simhash, toxicity
from geomere.llm.arrow import without
from geomere.llm.queries import vocabulary
from geomere.session import forget, ship, tables, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a known language. Texts without letters, null and empty ones too, are in none; ties go to the first language by name."""
    ship(spark)
    return without(docs, langid.rejected(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic. Null and empty texts aren't; equal texts have equal scores."""
    ship(spark)
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id, a null one last. Texts without words, null ones too, are one group."""
    ship(spark)
    return simhash.kept_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and n_chars of the text that is left. A null text stays null, with as many characters as before."""
    ship(spark)
    return pii.redacted(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences of 4096 tokens. A null or empty text is one piece of the end token."""
    ship(spark)
    return packing.packed(docs, vocabulary())


STAGES = [("language", language), ("toxicity", clean), ("simhash", distinct), ("pii", private), ("packing", packed)]

#: Hashing of shingles, EM and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), list(tables(spark))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        forget(spark, [*before, tables(spark)[-1]])
    return docs
