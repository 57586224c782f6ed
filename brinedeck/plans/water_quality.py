"""Combined water quality: every sampled trip and depth with all measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.functions.text import sample_code
from brinedeck.operators.quality import ctd_by_depth, sample_universe
from brinedeck.operators.shuffle import left_join_nullsafe

KEYS = ("TripCode", "SampleDepth_m")
CTD_MEASURES = {
    "CTDDensity_kgm3": "WaterDensity_kgm3", "CTDTemperature": "Temperature_degC", "CTDConductivity_sm": "Conductivity_Sm",
    "CTDSalinity": "Salinity_psu", "CTDChlF_mgm3": "Chla_mgm3", "CTDTurbidity_ntu": "Turbidity_NTU",
}


def combined_water_quality(
    trips: DataFrame, chemistry: DataFrame, pico: DataFrame, pigments: DataFrame, tss: DataFrame, ctd: DataFrame,
    ctd_measures: dict[str, str] | None = None, code_prefix: str = "NRS",
) -> DataFrame:
    """One row per trip and depth found in any source, and one per trip for the whole water column.

    Cast means are looked up by the same key and add no rows of their own.
    Every source is one row per key except pigments, whose replicates stay.
    """
    trip, depth = KEYS
    column = trips.select(trip, F.lit("WC").alias(depth))
    universe = sample_universe(KEYS, chemistry, pico, pigments, tss, column)
    out = universe.join(trips, trip, "left").withColumn("SampleCode", sample_code(F.col(trip), F.col(depth), code_prefix))
    casts = ctd_by_depth(ctd, trip, "Depth_m", ctd_measures or CTD_MEASURES, out_depth=depth)
    for source in (chemistry, pico, pigments, tss, casts):
        out = left_join_nullsafe(out, source, KEYS)
    return out
