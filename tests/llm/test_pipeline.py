"""The corpus pipeline, stage by stage, against brute force; and every query of the subpackage on a driver table."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from brinedeck.llm import toxicity
from tests.llm.test_operators import brute_classes, brute_fingerprint, brute_statistics
from tools.compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    kept = spark.createDataFrame(stages[0](spark, docs, SF).collect(), docs.schema)
    ids = {r["doc_id"] for r in kept.collect()}
    for r in docs.collect():
        n, *_, repeats = brute_statistics(r["text"])
        assert (r["doc_id"] in ids) == (n >= 50 and 100 * repeats <= 50 * n)  # too few labels here to certify a rule

    mild = spark.createDataFrame(stages[1](spark, kept, SF).collect(), docs.schema)
    scores = toxicity.toxicity(kept, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r["doc_id"] for r in mild.collect()} == {r["doc_id"] for r in scores.filter("predicted = 0").collect()}

    single = spark.createDataFrame(stages[2](spark, mild, SF).collect(), docs.schema)
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in mild.collect()}
    root = brute_classes(prints.values(), 2)
    first = {}
    for k in sorted(prints):
        first.setdefault(root[prints[k]], k)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(first.values())

    mixed = spark.createDataFrame(stages[3](spark, single, SF).collect(), docs.schema)
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(first.values()) and max(copies.values()) <= 3
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in single.collect()}
    assert sum(words[k] * n for k, n in copies.items()) == pytest.approx(sum(words.values()), rel=0.05)

    packed = stages[4](spark, mixed, SF).toPandas()
    assert packed[packed.piece == 0].groupby("doc_id").size().to_dict() == copies
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns called like those that the operators use, a map among them, come through unchanged; repeated and null ids too."""
    from brinedeck.llm import mixing, quality_rules, simhash

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = ["_score", "score", "row", "_row", "_id", "of", "_copy", "copy", "_copies", "_fp", "mark", "_root", "root", "_first", "_rank", "rank", "words", "component_id", "stratum", "kept", "cut", "size"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    wide = docs.select("*", *[F.concat_ws("/", F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names], F.create_map(F.lit("a"), F.col("n_chars")).alias("pairs"))
    stages = {
        "rules": lambda d: quality_rules.accepted(d, labels), "toxic": lambda d: toxicity.without_toxic(d, labels),
        "near": lambda d: simhash.without_near_duplicates(d, shingle=3, radius=2), "mix": lambda d: mixing.repeated(d, weights=(5.0, 2.0, 1.0), epochs=3.0),
    }
    for name, stage in stages.items():
        out = stage(wide)
        assert out.columns == wide.columns, name
        got = sorted([tuple(r) for r in out.select(*docs.columns).collect()], key=str)
        assert got == sorted([tuple(r) for r in stage(docs).collect()], key=str), name
        for n in names:
            assert out.filter(~F.col(n).eqNullSafe(F.concat_ws("/", F.lit(n), F.col("doc_id").cast("string")))).isEmpty(), (name, n)


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_all_operators_are_registered():
    names = set(queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(n for n in queries() if re.match(r"op\d+_", n)))
def test_query(spark, name):
    out = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql:
        assert difference(out.toPandas(), connect(SF).execute(sql).df()) == ""
    else:
        table = spark.read.parquet(f"{SF}/documents.parquet")
        assert out.select("doc_id").distinct().count() == table.count()
        assert out.filter(F.col("doc_id").isNull()).count() == 0
