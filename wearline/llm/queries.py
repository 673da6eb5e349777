"""Registered queries of the operators in this folder, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    archives,
    centroids,
    files,
    importance,
    kdtree,
    kneser_ney_rows,
    latent,
    phrases,
    preference,
    repair,
    secrets,
    sentencepiece_table,
    simhash,
    suffixes,
)
from .common import table
from .oracles import ORACLES


def op1_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    strength = preference.learn(docs, table(spark, sf_dir, "labels"))
    return preference.score(docs, strength)


def _scaled(by: int):
    """floor(by * x); kept as a double, so that infinite components stay what they are."""

    def scale(x):
        y = x.cast("double") * by
        return F.when(F.abs(y) < 2.0**62, F.floor(y).cast("double")).otherwise(y)

    return scale


def op3_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", _scaled(64)).alias("vector")
    )
    found = kdtree.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)
    return found.withColumn("score", F.col("score").try_cast("long"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_table.encode(table(spark, sf_dir, "documents"), model)


def op6_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = repair.write_shards(
        table(spark, sf_dir, "documents"),
        files.folder(spark, "ids"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        end_id=2,
    )
    return repair.read_shards(manifest)


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = archives.write_archives(table(spark, sf_dir, "pages"), files.folder(spark, "archives"))
    return archives.read_archives(manifest).drop("payload", "url")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secrets.BASE]
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.concat_ws(",", F.transform(base, as_text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", as_text)).alias("spans"),
    )


def op10_fmindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeated_phrases(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", _scaled(256)).alias("vector")
    )
    return centroids.cluster(vectors, 40, 5, "2", 64)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target, 5, 20, "42").drop("n_words")


def op13_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key are learned from."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(rest == 2, F.lit(False)).alias("held_out"))
    return kneser_ney_rows.learn_and_score(docs)


def _of_kind(kind: str):
    return F.filter("spans", lambda s: s["kind"] == kind)


QUERIES = {
    "op1_latent": op1_latent,
    "op2_preference": op2_preference,
    "op3_kdtree": op3_kdtree,
    "op4_simhash": op4_simhash,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_repair": op6_repair,
    "op7_suffixes": op7_suffixes,
    "op8_archives": op8_archives,
    "op9_secrets": op9_secrets,
    "op10_fmindex": op10_fmindex,
    "op11_threshold": op11_threshold,
    "op12_importance": op12_importance,
    "op13_kneser_ney": op13_kneser_ney,
}


__all__ = ["ORACLES", "QUERIES"]
