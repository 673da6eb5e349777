"""From documents to training text: five stages, each written as Parquet before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wearline.llm import latent, preference, secrets, sentencepiece_table, simhash
from wearline.llm.common import table
from wearline.session import pin

#: A learned classifier and a tokenizer cannot be put in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned quality reaches the cut (``preference.CUT``).

    The strengths are learned from the stage's own documents and ``labels``.
    """
    strength = preference.learn(docs, table(spark, sf_dir, "labels"))
    return preference.score(docs, strength, carry=True).filter("predicted = 1").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of three words, fingerprints that
    links of at most two differing bits connect."""
    return simhash.without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; each row is judged by its own text."""
    return latent.without_items(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by its kind in brackets."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the number of its ids and digests of ids and decoded text."""
    return sentencepiece_table.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", redaction),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name)
    return docs
