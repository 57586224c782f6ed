"""Sample by taxon tables: seven for phytoplankton, six for zooplankton."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import COPEPOD, NON_COPEPOD, PHYTO_GROUPS_EXCLUDED, PLACEHOLDER, ZOO_GROUPS_EXCLUDED
from brinedeck.functions.text import binomial, first_word, genus_species, is_identified_species
from brinedeck.operators.taxa import apply_change_log, group_totals, ids_long, raw_long, to_matrix
from brinedeck.sources.sinks import newest_first, write_product


def phyto_tables(
    samples: DataFrame, phyto: DataFrame, log: DataFrame, *, key: str, date: str, cells: str, biovolume: str,
    dims: Sequence[str] | None = None, towed: bool = False,
) -> dict[str, DataFrame]:
    """Long tables of raw names, higher groups, genera and species, by abundance and by biovolume.

    Species by abundance are named genus and species; by biovolume they keep
    the recorded name.  Towed samples use the former for both, and count names
    joined by a slash.
    """
    species = F.col("Species")
    named = phyto.withColumn("TaxonName", genus_species(F.col("Genus"), species))
    named_to_species = is_identified_species(species, allow_grp=True)
    single_species = is_identified_species(species, allow_grp=True, allow_slash=towed)

    def presence(obs: DataFrame, level: str, name: str, value: str, placeholder: str, plain=None, affected=None) -> DataFrame:
        return apply_change_log(
            samples, obs, log, level=level, key=key, date=date, name=name, value=value,
            placeholder=PLACEHOLDER[placeholder], dims=dims, plain_where=plain, affected_where=affected,
        )

    def groups(value: str) -> DataFrame:
        return group_totals(
            samples, phyto, key=key, group="TaxonGroup", value=value, exclude=PHYTO_GROUPS_EXCLUDED, placeholder=PLACEHOLDER["phyto_group"],
        )

    recorded = (named if towed else phyto).withColumn("Name", F.col("TaxonName"))
    return {
        "raw": raw_long(samples, phyto, key=key, name="TaxonName", value=cells, placeholder=PLACEHOLDER["raw"]),
        "groups": groups(cells),
        "genus": presence(phyto, "genus", "Genus", cells, "genus"),
        "species": presence(named.withColumn("Name", F.col("TaxonName")), "name", "Name", cells, "species", single_species, named_to_species),
        "groups_biovolume": groups(biovolume),
        "genus_biovolume": presence(phyto, "genus", "Genus", biovolume, "genus"),
        "species_biovolume": presence(recorded, "name", "Name", biovolume, "species", named_to_species, named_to_species),
    }


def zoo_tables(
    samples: DataFrame, zoo: DataFrame, log: DataFrame, *, key: str, date: str, value: str = "ZAbund_m3",
    dims: Sequence[str] | None = None, towed: bool = False,
) -> dict[str, DataFrame]:
    """Long tables of raw names, binned stages, higher groups, genera, copepods and other species.

    Towed samples count every group but copepods as other species.
    """
    species = F.col("Species")
    named = zoo.withColumn("Name", binomial(F.col("Genus"), species))
    is_copepod = F.col("Copepod") == COPEPOD
    is_other = F.col("Copepod") != COPEPOD if towed else F.col("Copepod") == NON_COPEPOD
    common = {"key": key, "date": date, "value": value, "dims": dims}

    def species_table(rows: DataFrame, allow_slash: bool, placeholder: str) -> DataFrame:
        rows = rows.filter(is_identified_species(species, allow_slash=allow_slash, allow_empty=False))
        return apply_change_log(samples, rows, log, level="name", name="Name", placeholder=PLACEHOLDER[placeholder], **common)

    return {
        "raw": raw_long(samples, zoo, key=key, name="TaxonName", value=value, placeholder=PLACEHOLDER["raw"]),
        "ids": ids_long(samples, zoo, key=key, taxon="TaxonName", genus="Genus", species="Species", value=value),
        "groups": group_totals(
            samples, zoo, key=key, group="TaxonGroup", value=value, exclude=ZOO_GROUPS_EXCLUDED, placeholder=PLACEHOLDER["zoo_group"],
        ),
        "genus": apply_change_log(
            samples, zoo, log, level="genus", name="Genus", placeholder=PLACEHOLDER["genus"], plain_name=first_word(F.col("Genus")), **common,
        ),
        "copepods": species_table(named.filter(is_copepod), False, "copepod"),
        "noncopepods": species_table(named.filter(is_other), True, "towed_noncopepod" if towed else "noncopepod"),
    }


def export_matrix(long: DataFrame, path: str, *, keys: Sequence[str], name: str, value: str, date: str) -> None:
    """Write a long table as a wide CSV matrix, newest sample first."""
    wide = to_matrix(long, keys, name, value, drop_names=[PLACEHOLDER["raw"]])
    write_product(newest_first(wide, date), path, "csv")
