"""From raw documents to packed training sequences: five stages, each one operator of the training-data package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.common import documents, shared_folder
from inkwell.llm.language import fit_language, identify
from inkwell.llm.mixing import mixed_documents
from inkwell.llm.neardup import near_groups
from inkwell.llm.packing import pack, tokenised_pieces
from inkwell.llm.queries import tokenizer_path
from inkwell.llm.suffixes import without_repeats

#: SQL can't express a trained classifier, sketches or a tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: texts without letters go, and those that fit no language better than
    another. Texts go with the decision in one pass, so that rows of one id stay apart."""
    return identify(docs, fit_language(docs), keep_rows=True).filter("lang_pred != 'und' and not ambiguous").select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id. Rows of that
    id all stay, and so do rows without an id."""
    gone = near_groups(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the 100-byte strings that start earlier elsewhere. Buckets are half as large as by
    default, since executors still hold what earlier stages left."""
    return without_repeats(docs, bucket_bytes=4_000_000)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as much of them, as their source's target asks for."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents in sequences of 2048 tokens."""
    return pack(tokenised_pieces(docs, tokenizer_path()))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each one's result is written as Parquet to the cluster's shared
    folder and read again, so that a lost executor costs no earlier stage."""
    top, docs = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}-{name}")
        docs = spark.read.parquet(f"{top}/{k}-{name}")
    return docs
