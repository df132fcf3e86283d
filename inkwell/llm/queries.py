"""The thin opN queries: each applies its operator with production parameters to the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import alignment_support
from .centroids import centroid_clusters
from .common import documents
from .factors import remove_repeated_words
from .fingerprint import fingerprints
from .language import fit_language, identify
from .mixing import mix_sources
from .neardup import near_groups
from .oracle import ORACLE_SQL as ORACLE_SQL
from .packing import pack, tokenised_pieces
from .quality import line_quality
from .sharding import shard_documents
from .suffixes import remove_repeats
from .tokens import token_counts
from .toxicity import toxicity


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit_language(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(documents(spark, sf_dir))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(tokenised_pieces(documents(spark, sf_dir), tokenizer_path()))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), words=2)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return alignment_support(documents(spark, sf_dir), a, b).select(*names)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_quality": op2_line_quality,
    "op3_language_id": op3_language_id,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_fingerprint": op6_fingerprint,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_source_mix": op10_source_mix,
    "op11_token_alignment": op11_token_alignment,
    "op12_sharding": op12_sharding,
    "op13_centroid_clusters": op13_centroid_clusters,
}
