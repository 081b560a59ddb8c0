"""From raw documents to token ids: quality rules, exact and near duplicates, mixing of sources, byte-pair encoding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept. ``run`` writes what a
stage returns as Parquet below the shared folder and reads it again, so lost executors cost no finished stage.

Defined results: a null text is empty, fails the quality rules and goes; extra columns of the input travel along up to
the last stage; an empty table stays empty; rows that repeat id and text become one at the exact duplicates. The mixing
stage realises how often each row appears; blocks and places, which are no columns of documents, are ``op3``'s result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe, exact_dedup, mixing, quality, simhash
from tidemart.llm.queries import vocabulary
from tidemart.llm.tables import discard, new_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or look unlike trusted text go."""
    return quality.good_documents(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.without_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of close fingerprints the row with the smallest doc_id stays."""
    return simhash.without_near_duplicates(docs, shingle=3, max_distance=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again, up to the temperature's weights."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens."""
    encoded = bpe.token_ids(docs, vocabulary("word_bpe_49k.json"))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("encoding", encoding),
]

# The hashes of the quality rules and fingerprints and the merges of the encoder have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the table of a stage goes once the next one is written."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if read is not None:
            discard(read)
        docs = read = spark.read.parquet(path)
    return docs
