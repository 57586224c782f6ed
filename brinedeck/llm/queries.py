"""The operators of this subpackage on the driver tables, one query each, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinedeck.llm import backoff, binary_ids, merkle, mixing, neighbours, oracle, packing, quality_model, quality_rules, ranked_search, repeats, sharding, simhash, toxicity

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=4096, end_id=1)


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector, against all vectors."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source weights 5, 2, 1 with at most three epochs."""
    return mixing.mix(_table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), epochs=3.0)


def op4_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal counts, equal texts together."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a classifier trained on the labels outside the held-out fifth."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict of all documents."""
    found = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a factorisation machine trained on the labels outside the held-out fifth."""
    return quality_model.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents (3-word shingles) and their classes within 2 bits."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents by the bigrams and words of all other documents."""
    scored = backoff.backoff_scores(_table(spark, sf_dir, "documents"), order=2, penalty=0.4)
    return scored.select("doc_id", "n_words", F.round("log10_sum", 4).alias("log10_sum"), F.round("log10_mean", 6).alias("log10_mean"))


def op9_backoff_scores_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents by the trigrams, bigrams and words of all other documents."""
    scored = backoff.backoff_scores(_table(spark, sf_dir, "documents"), order=3, penalty=0.4)
    return scored.select("doc_id", "n_words", F.round("log10_sum", 4).alias("log10_sum"), F.round("log10_mean", 6).alias("log10_mean"))


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in binary files, and what the files hold."""
    return binary_ids.token_id_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)[1]


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents for every benchmark item."""
    return ranked_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 200 bytes that occur more than once."""
    return repeats.without_repeats(_table(spark, sf_dir, "documents"), length=200)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verdict of all documents; every seventh by crc32 claims one character more than it was entered with."""
    return merkle.manifest(
        _table(spark, sf_dir, "documents"),
        tampered=lambda doc_id: F.crc32(doc_id.cast("string")) % 7 == 0,
        changed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
    )


QUERIES = {f.__name__: f for f in (
    op1_pack_sequences, op2_nearest_vectors, op3_mix_sources, op4_shard_documents, op5_toxicity, op6_quality_rules, op7_quality_model,
    op8_simhash_groups, op9_backoff_scores, op9_backoff_scores_order3, op10_token_id_files, op11_ranked_search, op12_repeats, op13_merkle_manifest,
)}
SQL = oracle.SQL
