"""Column summaries with exact quartiles of any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.functions.missing import nan_to_null

ACCURACY = 100_000


def describe_measures(df: DataFrame, measures: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75), accuracy: int = ACCURACY) -> DataFrame:
    """Min, quartiles, mean, max and missing count of each measure.

    Quartiles interpolate between order statistics and are exact.  A sketch
    first brackets each quartile within about ``4 / accuracy`` of the rows;
    one more scan counts the rows under the bracket and groups the values
    inside it, and only those few are put in order.  The sketch table has one
    row per measure, which is what makes its broadcast safe.
    """
    long = df.select(*[nan_to_null(F.col(m).cast("double")).alias(m) for m in measures]).unpivot(
        [], list(measures), "measure", "v"
    )
    margin = 2.0 / accuracy
    points = [p for q in quantiles for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    stats = long.groupBy("measure").agg(
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("n_missing"),
        F.min("v").alias("min"), F.avg("v").alias("mean"), F.max("v").alias("max"),
        F.percentile_approx("v", points, accuracy).alias("_cuts"),
    )
    brackets = F.array(*[
        F.struct(
            F.lit(i).alias("q"), F.lit(float(q)).alias("p"),
            F.col("_cuts")[2 * i].alias("lo"), F.col("_cuts")[2 * i + 1].alias("hi"),
        ) for i, q in enumerate(quantiles)
    ])
    looked = long.filter("v is not null").join(
        F.broadcast(stats.select("measure", brackets.alias("_b"))), "measure"
    ).select("measure", "v", F.inline("_b"))
    # below and above the bracket only the value next to it is of interest; inside, every value
    place = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") <= F.col("hi"), 0).otherwise(1)
    inside_value = F.when(place == 0, F.col("v"))
    counted = looked.groupBy("measure", "q", "p", place.alias("_place"), inside_value.alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), F.when(F.col("_place") < 0, F.max("v")).otherwise(F.min("v")).alias("_v")
    )
    line = W.partitionBy("measure", "q").orderBy("_place", "_at")
    upto = F.sum("_n").over(line.rowsBetween(W.unboundedPreceding, 0))
    steps = counted.withColumn("_upto", upto).join(
        F.broadcast(stats.select("measure", "n")), "measure"
    )
    h = (F.col("n") - 1) * F.col("p")
    lower, upper = F.floor(h) + 1, F.ceil(h) + 1
    quartiles = steps.groupBy("measure", "q").agg(
        F.min(F.when(F.col("_upto") >= lower, F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_upto") >= upper, F.col("_v"))).alias("_c"),
        F.first(h - F.floor(h)).alias("_w"),
    ).withColumn("_value", F.col("_a") + (F.col("_c") - F.col("_a")) * F.col("_w"))
    wide = quartiles.groupBy("measure").agg(*[
        F.max(F.when(F.col("q") == i, F.col("_value"))).alias(f"p{round(q * 100):02d}") for i, q in enumerate(quantiles)
    ])
    return stats.drop("_cuts").join(F.broadcast(wide), "measure", "left")
