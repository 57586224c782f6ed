"""A key that holds a third of all rows: results stay whole and the rows stay spread."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brinedeck.operators import indices, matching, profile, taxa
from brinedeck.operators.shuffle import salted_lookup
from tests.conftest import rows

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 has a third of the rows, the others are even."""
    i = F.col("id")
    return spark.range(N).select(
        i, F.when(i % 3 == 0, F.lit(0)).otherwise(1 + i % 997).alias("k"), (i % 40).alias("taxon"), (i % 7).cast("double").alias("v"),
        (i % 200).cast("double").alias("depth"),
    ).cache()


def test_salted_lookup_spreads_the_hot_key(spark, skewed):
    lookup = skewed.groupBy("k").agg(F.max("v").alias("top"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = salted_lookup(skewed, lookup, ["k"], F.col("id"))
        assert joined.count() == N and joined.filter("top is null").count() == 0
        per_task = [r["n"] for r in joined.filter("k = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(per_task) > 1 and max(per_task) < 0.8 * N / 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_indices_reduce_before_the_shuffle(spark, skewed):
    plan = indices.diversity(
        skewed, key="k", name=F.col("taxon"), value="v", groups={"g": F.lit(True)}
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan


def test_hot_profile_is_reduced_not_sorted_whole(spark, skewed):
    casts = skewed.select("k", "depth", F.col("v").alias("t"), (F.col("v") + 30).alias("s"), F.col("v").alias("c"))
    out = profile.mixed_layer(casts, trip="k", depth="depth", temperature="t", salinity="s", chlorophyll="c", ref_depth=F.lit(10.0))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    hot = skewed.filter("k = 0").toPandas()
    ref = hot.assign(gap=(hot.depth - 10).abs()).sort_values(["gap", "depth", "v"]).iloc[0]
    below = hot[hot.depth > ref.depth].assign(gap=lambda d: (d.v - (ref.v - 0.4)).abs()).sort_values(["gap", "depth"])
    got = out.filter("k = 0").first()
    assert got["MLD_temp"] == below.iloc[0].depth and got["DCM"] == below[below.v == below.v.max()].depth.min()


def test_busy_station_is_cut_by_time(spark):
    t0 = dt.datetime(2020, 1, 1)
    stamp = lambda c: F.timestamp_seconds(F.unix_seconds(F.lit(t0).cast("timestamp")) + c).cast("timestamp_ntz")
    i = F.col("id")
    station = F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (i % 50).cast("string")))
    left = spark.range(20_000).select(station.alias("s"), stamp(i * 900).alias("t"))
    right = spark.range(20_000).select(station.alias("s"), stamp(i * 900 + 60).alias("c"))
    args = {"station": "s", "left_ts": "t", "right_ts": "c", "tolerance": 0.5, "tolerance_by_station": {}}
    out = matching.nearest_times(left, right, **args)
    assert out.count() == left.distinct().count()
    assert rows(out.select("gap_h").distinct()) == [(60 / 3600,)]


def test_raw_table_keeps_every_record_of_a_hot_sample(spark, skewed):
    samples = spark.range(1100).withColumnRenamed("id", "k").withColumn("station", F.lit("A"))
    long = taxa.raw_long(samples, skewed.withColumn("n", F.col("taxon").cast("string")), key="k", name="n", value="v", placeholder="none")
    assert long.filter("k = 0").count() == N / 3
    assert long.count() == N + 1100 - skewed.select("k").distinct().count()
