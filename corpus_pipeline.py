"""From raw documents to packed sequences.

Each stage takes the table that its predecessor wrote and works on all of it: rejected, toxic
and near-duplicate rows go, mixed rows occur as often as they are taken, and the last stage
returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from brinedeck.llm import mixing, packing, quality_rules, simhash, toxicity
from brinedeck.llm.common import settle

TOKENIZER = "word_bpe_49k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep."""
    return quality_rules.accepted(docs.select(COLUMNS), _labels(spark, sf_dir))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.without_toxic(docs.select(COLUMNS), _labels(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (3-word shingles, 2 bits)."""
    return simhash.without_near_duplicates(docs.select(COLUMNS), shingle=3, radius=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.repeated(docs.select(COLUMNS), weights=(5.0, 2.0, 1.0), epochs=3.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs.select(COLUMNS), public_tokenizers.path(TOKENIZER), capacity=4096, end_id=1)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Fingerprints, n-gram hashes and the tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs)
    return docs
