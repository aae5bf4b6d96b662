"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprint, knn, langid, merkle, packing, pii, quality, simhash, spelling, tokens, toxicity

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and passages of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.packed(_table(spark, sf_dir, "documents"), vocabulary())


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every document and of its edited text."""
    return fingerprint.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, from its text, declaration, address and host."""
    return langid.page_languages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return bpe.encoded_digest(_table(spark, sf_dir, "documents"), vocabulary())


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for each query vector."""
    return knn.top_k(_table(spark, sf_dir, "embeddings"), F.col("_id") % 100 == 0)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the strict spans, and all spans."""
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return tokens.token_counts(_table(spark, sf_dir, "documents"), vocabulary())


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation: calls linked to their results, ordered, checked and serialised, and the turns of other roles."""
    return chat.turns(_table(spark, sf_dir, "conversations"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all frequent words of the documents."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, checked against texts of which half are tampered with."""
    return merkle.proved_digest(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, score and verdict of every document."""
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_fingerprint": op4_fingerprint,
    "op5_language": op5_language,
    "op6_bpe": op6_bpe,
    "op7_top_k": op7_top_k,
    "op8_pii": op8_pii,
    "op9_token_counts": op9_token_counts,
    "op10_chat": op10_chat,
    "op11_spelling": op11_spelling,
    "op12_merkle": op12_merkle,
    "op13_quality": op13_quality,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op10_chat": chat.TURNS_SQL}
