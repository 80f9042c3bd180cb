"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    alignment,
    bpe,
    hnsw,
    licenses,
    manifest,
    minhash,
    mixing,
    quality,
    sharding,
    substrings,
    suffixes,
    token_counts,
    topk,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def vocabulary() -> str:
    """The vocabulary file; installed in the same place on every machine."""
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces() -> str:
    """The second vocabulary."""
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark, sf_dir):
    """(doc_id, char_start, char_end, n_words, first_id) of every repeated passage."""
    return substrings.passages(documents(spark, sf_dir)).drop("_text")


def op2_bpe(spark, sf_dir):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return bpe.digests(documents(spark, sf_dir), vocabulary())


def op3_sharding(spark, sf_dir):
    """(doc_id, slot, shard): every document on one of 64 shards."""
    return sharding.place(documents(spark, sf_dir), "doc_id", sharding.shard_names(64))


def op4_licenses(spark, sf_dir):
    """Words, base places, labels, score and spans of every document."""
    return licenses.scan(documents(spark, sf_dir))


def op5_token_counts(spark, sf_dir):
    """(doc_id, section, char_start, char_end, n_tokens, n_border) of every line."""
    return token_counts.attribute(documents(spark, sf_dir), vocabulary(), rule="most")


def op6_exact_topk(spark, sf_dir):
    """(query_id, rank, vec_id, score): 20 best for each id divisible by 20."""
    return topk.top_k(embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0)


def op7_mixing(spark, sf_dir):
    """(doc_id, size, source_size, target, taken) of every document."""
    mixed = mixing.mixture(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_quality(spark, sf_dir):
    """(doc_id, log_weight, key) of the documents drawn as good ones."""
    return quality.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_minhash(spark, sf_dir):
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return minhash.near_duplicates(documents(spark, sf_dir), minhash.Near(width=3, percent=85))


def op10_hnsw(spark, sf_dir):
    """(query_id, rank, vec_id, score): 20 nearest found for each id divisible by 20."""
    return hnsw.nearest(embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0)


def op11_manifest(spark, sf_dir):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    return manifest.audit(documents(spark, sf_dir))


def op12_suffix_dedup(spark, sf_dir):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return suffixes.digests(documents(spark, sf_dir))


def op13_alignment(spark, sf_dir):
    """Tokens, groups and links of every document, and digests of its groups."""
    return alignment.summary(documents(spark, sf_dir), vocabulary(), pieces())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_bpe": op2_bpe,
        "op3_sharding": op3_sharding,
        "op4_licenses": op4_licenses,
        "op5_token_counts": op5_token_counts,
        "op6_exact_topk": op6_exact_topk,
        "op7_mixing": op7_mixing,
        "op8_quality": op8_quality,
        "op9_minhash": op9_minhash,
        "op10_hnsw": op10_hnsw,
        "op11_manifest": op11_manifest,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_alignment": op13_alignment,
    }
