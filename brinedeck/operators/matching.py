"""Nearest-in-time matching of samples to instrument casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.fixed_values import CAST_TOLERANCE_BY_STATION_H, CAST_TOLERANCE_H
from brinedeck.functions.timefn import micros

HOUR = 3_600_000_000


def nearest_times(
    left: DataFrame, right: DataFrame, *, station: str, left_ts: str, right_ts: str,
    tolerance: float = CAST_TOLERANCE_H, tolerance_by_station: Mapping | None = None, matched: str = "matched_ts",
) -> DataFrame:
    """Distinct (station, time) of the left table with the nearest time of the right one.

    The earlier time wins a tie; times beyond the station's tolerance do not
    match.  Time is cut into buckets as wide as the largest tolerance and each
    right time also enters the two neighbouring buckets, so a match is always
    found inside one bucket.  A task sorts the distinct times of one station
    in three bucket widths, however long or busy the station's record is.
    """
    by_station = dict(CAST_TOLERANCE_BY_STATION_H if tolerance_by_station is None else tolerance_by_station)
    width = int(max([tolerance, *by_station.values()]) * HOUR)
    limit = F.lit(float(tolerance))
    for code, hours in by_station.items():
        limit = F.when(F.col(station) == code, F.lit(float(hours))).otherwise(limit)

    times = left.select(station, F.col(left_ts).alias("_t")).filter("_t is not null").distinct()
    lefts = times.select(station, "_t", micros(F.col("_t")).alias("_us")).withColumn(
        "_bucket", F.expr(f"_us div {width}")
    )
    rights = (
        right.select(station, F.col(right_ts).alias("_t")).filter("_t is not null").distinct()
        .select(station, "_t", micros(F.col("_t")).alias("_us"))
        .withColumn("_home", F.expr(f"_us div {width}"))
        .withColumn("_bucket", F.explode(F.array(F.col("_home") - 1, F.col("_home"), F.col("_home") + 1)))
    )
    line = lefts.select(station, "_bucket", "_us", "_t", F.lit(True).alias("_left")).unionByName(
        rights.select(station, "_bucket", "_us", "_t", F.lit(False).alias("_left"))
    )
    cast = F.when(~F.col("_left"), F.struct("_us", "_t"))
    part = W.partitionBy(station, "_bucket")
    up_to_here = part.orderBy(F.col("_us"), F.col("_left")).rowsBetween(W.unboundedPreceding, 0)
    from_here = part.orderBy(F.col("_us").desc(), F.col("_left")).rowsBetween(W.unboundedPreceding, 0)
    line = line.withColumn("_prev", F.last(cast, ignorenulls=True).over(up_to_here))
    line = line.withColumn("_next", F.last(cast, ignorenulls=True).over(from_here))
    back = F.col("_us") - F.col("_prev._us")
    ahead = F.col("_next._us") - F.col("_us")
    pick = F.when(ahead.isNull() | (back <= ahead), F.col("_prev")).otherwise(F.col("_next"))
    gap_h = F.abs(F.col("_us") - F.col("_pick._us")) / F.lit(float(HOUR))
    return (
        line.filter("_left").withColumn("_pick", pick).withColumn("gap_h", gap_h)
        .select(
            station, F.col("_t").alias(left_ts),
            F.when(F.col("gap_h") <= limit, F.col("_pick._t")).alias(matched),
            F.when(F.col("gap_h") <= limit, F.col("gap_h")).alias("gap_h"),
        )
    )


def nearest_join(
    left: DataFrame, right: DataFrame, *, station: str, left_ts: str, right_ts: str,
    tolerance: float = CAST_TOLERANCE_H, tolerance_by_station: Mapping | None = None,
) -> DataFrame:
    """Left rows that have a match, with every right row of the matched time."""
    pairs = nearest_times(
        left, right, station=station, left_ts=left_ts, right_ts=right_ts,
        tolerance=tolerance, tolerance_by_station=tolerance_by_station, matched=right_ts,
    ).filter(F.col(right_ts).isNotNull())
    return left.join(pairs, [station, left_ts]).join(right, [station, right_ts])


def match_casts(
    samples: DataFrame, casts: DataFrame, *, trip: str, sample_ts: str, cast_ts: str, cast_id: str,
    sample_station: Column, cast_station: Column,
    tolerance: float = CAST_TOLERANCE_H, tolerance_by_station: Mapping | None = None,
) -> DataFrame:
    """Every cast row with the trip it belongs to.

    A cast near two samples appears for both; one near none keeps a NULL trip.
    """
    left = samples.select(sample_station.alias("_station"), sample_ts, trip).distinct()
    right = casts.select(cast_station.alias("_station"), cast_ts, cast_id).distinct()
    pairs = nearest_join(
        left, right, station="_station", left_ts=sample_ts, right_ts=cast_ts,
        tolerance=tolerance, tolerance_by_station=tolerance_by_station,
    ).select(cast_id, trip)
    return casts.drop(trip).join(pairs, cast_id, "left")
