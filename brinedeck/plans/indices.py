"""Index tables of station trips and of towed-recorder samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import COPEPOD, DIATOM_GROUPS, DINOFLAGELLATE, SURFACE_PIGMENT_DEPTH_M
from brinedeck.functions.ocean import reference_depth
from brinedeck.functions.text import binomial, is_identified_species
from brinedeck.operators.indices import assemble_indices, diversity, phyto_sums, zoo_indices
from brinedeck.operators.profile import mixed_layer
from brinedeck.operators.quality import ctd_surface, mean_by_key

_GROUP_NAMES = {"Copepod": "Copepod", "Phyto": "Phyto", "Diatom": "Diatom", "Dino": "Dinoflagellate"}


def _named(found: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """Output names of the diversity columns."""
    out = [F.col(key)]
    for g in groups:
        out += [
            F.col(f"{g}_richness").alias(f"No{g}Species_Sample"), F.col(f"{g}_shannon").alias(f"Shannon{g}Diversity"),
            F.col(f"{g}_evenness").alias(f"{_GROUP_NAMES[g]}Evenness"),
        ]
    return found.select(*out)


def plankton_features(
    zoo: DataFrame, zoo_count: DataFrame, phyto: DataFrame, traits: DataFrame, *, key: str,
    zoo_value: str, cells: str, biovolume: str, unit: str,
) -> list[DataFrame]:
    """Feature tables of one key, each from one scan of its source."""
    counted = F.col("TaxonGroup") != "Other"
    phyto = phyto.filter(counted)
    species = is_identified_species(F.col("Species"))
    name = binomial(F.col("Genus"), F.col("Species"))
    copepods = diversity(
        zoo_count, key=key, name=name, value="TaxonCount", groups={"Copepod": (F.col("Copepod") == COPEPOD) & species},
    )
    algae = diversity(phyto, key=key, name=name, value=cells, groups={
        "Phyto": species,
        "Diatom": F.col("TaxonGroup").isin(*DIATOM_GROUPS) & species,
        "Dino": (F.col("TaxonGroup") == DINOFLAGELLATE) & species,
    })
    return [
        zoo_indices(zoo, traits, key=key, taxon="TaxonName", value=zoo_value, copepod=F.col("Copepod") == COPEPOD),
        _named(copepods, key, ["Copepod"]),
        phyto_sums(phyto, key=key, group="TaxonGroup", cells=cells, biovolume=biovolume, unit=unit),
        _named(algae, key, ["Phyto", "Diatom", "Dino"]),
    ]


def _diet_of_complete_samples(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The diet share counts complete rows only, so a sample with a missing column of its own has none."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    ratio = "HerbivoreCarnivoreCopepodRatio"
    return table.withColumn(ratio, F.when(complete, F.col(ratio)))


def _no_zoo_is_zero(table: DataFrame) -> DataFrame:
    return table.withColumn("ZoopAbundance_m3", F.coalesce("ZoopAbundance_m3", F.lit(0.0)))


def station_indices(
    trips: DataFrame, zoo: DataFrame, zoo_count: DataFrame, phyto: DataFrame, traits: DataFrame,
    ctd: DataFrame, chemistry: DataFrame, pigments: DataFrame, excluded_station: str = "Port Hacking 4",
) -> DataFrame:
    """One row per trip: plankton indices, surface cast means, mixed layer, nutrients, surface pigment."""
    key = "TripCode"
    base = trips.filter(F.col("Station") != excluded_station)
    surface = ctd_surface(ctd, key, "Depth_m", {"CTD_SST_C": "Temperature_degC", "CTDChla_mgm3": "Chla_mgm3", "CTDSalinity_psu": "Salinity_psu"})
    layer = mixed_layer(
        ctd.filter(F.col(key).isNotNull()), trip=key, depth="Depth_m", temperature="Temperature_degC", salinity="Salinity_psu",
        chlorophyll="Chla_mgm3", ref_depth=reference_depth(F.col(key)),
    )
    nutrients = mean_by_key(chemistry, [key], {c: c for c in chemistry.columns if c not in (key, "SampleDepth_m")})
    pigment = mean_by_key(
        pigments, [key], {"Chla_mgm3": "Chla"}, F.col("SampleDepth_m").try_cast("double") <= SURFACE_PIGMENT_DEPTH_M
    )
    features = plankton_features(
        zoo, zoo_count, phyto, traits, key=key, zoo_value="ZAbund_m3", cells="Cells_L", biovolume="Biovolume_um3L", unit="L",
    )
    out = assemble_indices(base, [*features, surface, layer, nutrients, pigment], key)
    return _no_zoo_is_zero(_diet_of_complete_samples(out, trips.columns)).drop("SampleType")


def tow_indices(
    samples: DataFrame, zoo: DataFrame, zoo_count: DataFrame, phyto: DataFrame, traits: DataFrame, props: DataFrame | None = None,
) -> DataFrame:
    """One row per towed-recorder sample; with ``props`` also satellite chlorophyll and water depth."""
    key = "Sample"
    features = plankton_features(
        zoo, zoo_count, phyto, traits, key=key, zoo_value="ZAbund_m3", cells="PAbun_m3", biovolume="BioVolume_um3m3", unit="m3",
    )
    if props is not None:
        features = [props, *features]
    own = [c for c in samples.columns if c not in ("Region", "PCI", "Biomass_mgm3")]
    return _diet_of_complete_samples(assemble_indices(samples, features, key), own)
