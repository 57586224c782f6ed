"""Mixed-layer depth and deep chlorophyll maximum of vertical profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import MLD_SALINITY_DROP, MLD_TEMPERATURE_DROP
from brinedeck.operators.shuffle import SALTS, salted_lookup


def reference_sample(profile: DataFrame, *, trip: str, depth: str, measures: list[str], ref_depth: Column) -> DataFrame:
    """The sample of each profile nearest to its reference depth, shallower on ties."""
    gap = F.abs(F.col(depth) - ref_depth)
    order = F.struct(gap.isNull(), gap, F.col(depth), *[F.col(m) for m in measures])
    row = F.struct(F.col(depth).alias("depth"), *[F.col(m) for m in measures])
    return profile.groupBy(trip).agg(F.min_by(row, order).alias("_ref"))


def mixed_layer(
    profile: DataFrame, *, trip: str, depth: str, temperature: str, salinity: str, chlorophyll: str,
    ref_depth: Column, drop_t: float = MLD_TEMPERATURE_DROP, drop_s: float = MLD_SALINITY_DROP, salts: int = SALTS,
) -> DataFrame:
    """``MLD_temp``, ``MLD_sal`` and ``DCM`` of every profile.

    Below the reference sample, the mixed-layer depth is where temperature
    (salinity) is nearest to the reference value minus a drop; the chlorophyll
    maximum is the shallowest depth holding the largest positive value, unknown
    if any value below is.  Profiles with nothing below get NULL.  All three
    are ordered minima, so a profile is reduced by partial aggregation and
    never sorted.
    """
    ref = reference_sample(profile, trip=trip, depth=depth, measures=[temperature, salinity], ref_depth=ref_depth)
    rows = salted_lookup(
        profile.select(trip, depth, temperature, salinity, chlorophyll), ref, [trip],
        F.struct(depth, temperature, salinity, chlorophyll), salts,
    )
    d, chl = F.col(depth), F.col(chlorophyll)
    below = F.coalesce(d > F.col("_ref.depth"), F.lit(False))

    def nearest(value: str, drop: float) -> Column:
        gap = F.abs(F.col(value) - (F.col(f"_ref.{value}") - F.lit(drop)))
        return F.min_by(F.when(below, d), F.when(below, F.struct(gap.isNull(), gap, d)))

    dcm = F.min_by(F.when(below, d), F.when(below, F.struct(-chl, d)))
    dcm_known = (F.count_if(below & chl.isNull()) == 0) & (F.max(F.when(below, chl)) > 0)
    return rows.groupBy(trip).agg(
        nearest(temperature, drop_t).alias("MLD_temp"),
        nearest(salinity, drop_s).alias("MLD_sal"),
        F.when(dcm_known, dcm).alias("DCM"),
    )


def chlorophyll_maxima(
    profile: DataFrame, *, trip: str, depth: str, chlorophyll: str, ref_depth: Column, salts: int = SALTS,
) -> DataFrame:
    """All depths that share the chlorophyll maximum below the reference sample.

    One row per tied depth; a profile without a maximum has one row with NULL.
    """
    ref = reference_sample(profile, trip=trip, depth=depth, measures=[chlorophyll], ref_depth=ref_depth)
    spread = F.struct(depth, chlorophyll)
    rows = salted_lookup(profile.select(trip, depth, chlorophyll), ref, [trip], spread, salts)
    below = F.coalesce(F.col(depth) > F.col("_ref.depth"), F.lit(False))
    chl = F.col(chlorophyll)
    top = rows.groupBy(trip).agg(
        F.when(F.count_if(below & chl.isNull()) == 0, F.max(F.when(below, chl))).alias("_max"),
    )
    peaks = salted_lookup(rows, top, [trip], spread, salts).filter(below & (chl == F.col("_max")) & (chl > 0))
    return top.select(trip).join(peaks.groupBy(trip, depth).agg(F.lit(1)).select(trip, F.col(depth).alias("DCM")), trip, "left")
