"""Product sets are published as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from brinedeck.sources.sinks import publish_set, read_published
from tests.conftest import rows


def test_a_set_replaces_the_earlier_one_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "products")
    a, b = spark.range(3).toDF("v"), spark.range(5).toDF("v")
    assert publish_set({"a": a, "b": b}, root) == 1
    # derived from its own earlier edition
    assert publish_set({"a": read_published(spark, root, "a").withColumn("v", F.col("v") + 10)}, root) == 2
    assert rows(read_published(spark, root, "a")) == [(10,), (11,), (12,)]
    assert rows(read_published(spark, root, "a", edition=1)) == [(0,), (1,), (2,)]
    with pytest.raises(LookupError):
        read_published(spark, root, "b")


def test_a_failed_write_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path / "products")
    publish_set({"a": spark.range(3).toDF("v"), "b": spark.range(1).toDF("v")}, root, "csv")
    bad = spark.range(2).select(F.when(F.col("id") == 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="broken"):
        publish_set({"a": spark.range(9).toDF("v"), "b": bad}, root, "csv")
    assert rows(read_published(spark, root, "a")) == [("0",), ("1",), ("2",)]
    assert rows(read_published(spark, root, "b")) == [("0",)]


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        read_published(spark, str(tmp_path / "none"), "a")
    with pytest.raises(ValueError):
        publish_set({}, str(tmp_path / "none"))
