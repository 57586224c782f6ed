"""Join shapes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def salted_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: Column, salts: int = SALTS) -> DataFrame:
    """Left join of many rows per key to a table with one row per key.

    Used where the result is aggregated by the same key again: adaptive
    execution cannot split a skewed key there, so the rows of a key are spread
    over ``salts`` partitions by a hash of ``spread`` and the lookup row is
    repeated that often.  The hash comes from the row's own values, so a
    recomputed partition gets the same salts.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")


def keep_all_samples(samples: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Left join of samples to their raw rows, with the long side on the splittable side.

    Equal to ``samples LEFT JOIN found``, written as found rows with their
    sample plus the samples without any row, because only the left side of a
    join is split when one sample holds most of the rows.
    """
    matched = found.join(samples, key, "inner")
    empty = samples.join(found.select(key).distinct(), key, "left_anti")
    return matched.unionByName(empty, allowMissingColumns=True)


def ranked_in_buckets(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], out: str = "rank") -> DataFrame:
    """Rank from 1 within ``group``, without sorting a whole group in one task.

    ``bucket`` must be non-decreasing in ``order``.  Rows before a bucket are
    counted by one small aggregation, and only the rows of a bucket are sorted
    together.
    """
    from pyspark.sql import Window as W

    sizes = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*group, bucket).orderBy(*order)
    return (
        rows.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, [*group, bucket])
        .withColumn(out, F.col("_before") + F.col("_pos"))
        .drop("_before", "_pos")
    )


def left_join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi-join in which a NULL key matches a NULL key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, "left").drop(*[f"_r_{k}" for k in keys])
