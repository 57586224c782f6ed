"""Abundance, ratio, carbon and diversity indices per sample.

Every index aggregates records by sample first, so that records are shuffled
as partial sums, and meets the sample table only as one row per sample.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import CARNIVORE_DIET, DIATOM_GROUPS, DINOFLAGELLATE
from brinedeck.functions.missing import is_in, ratio, sum_or_zero, sum_strict
from brinedeck.functions.ocean import cell_carbon


def total_abundance(obs: DataFrame, key: str, value: str, out: str, where: Column | None = None) -> DataFrame:
    rows = obs if where is None else obs.filter(where)
    return rows.groupBy(key).agg(sum_or_zero(F.col(value)).alias(out))


def weighted_mean_size(
    obs: DataFrame, traits: DataFrame, *, key: str, taxon: str, value: str, size: str,
    out: str = "AvgTotalLengthCopepod_mm",
) -> DataFrame:
    """Abundance-weighted mean size; the two sums skip NULL independently."""
    rows = obs.join(traits.select(taxon, size), taxon, "inner")
    n = F.col(value)
    return rows.groupBy(key).agg(ratio(sum_or_zero(F.col(size) * n), sum_or_zero(n)).alias(out))


def diet_ratio(
    obs: DataFrame, traits: DataFrame, *, key: str, taxon: str, value: str, diet: str = "DIET",
    complete_over: Sequence[str] | None = None, out: str = "HerbivoreCarnivoreCopepodRatio",
) -> DataFrame:
    """Share of non-carnivores; NULL unless both diets occur in the sample.

    Only rows complete in ``complete_over`` count (default: in every column).
    """
    rows = obs.join(traits.select(taxon, diet), taxon, "inner").dropna(subset=list(complete_over) if complete_over else None)
    carnivore = F.col(diet) == CARNIVORE_DIET
    cc = F.sum(F.when(carnivore, F.col(value)))
    co = F.sum(F.when(~carnivore, F.col(value)))
    return rows.groupBy(key).agg(ratio(co, co + cc).alias(out))


def group_share(
    obs: DataFrame, *, key: str, group: str, value: str,
    part: Sequence[str] = DIATOM_GROUPS, other: Sequence[str] = (DINOFLAGELLATE,),
    out: str = "DiatomDinoflagellateRatio",
) -> DataFrame:
    """part / (part + other); NULL unless both occur in the sample."""
    p = _sum_where(is_in(F.col(group), part), F.col(value))
    o = _sum_where(is_in(F.col(group), other), F.col(value))
    return obs.filter(is_in(F.col(group), [*part, *other])).groupBy(key).agg(ratio(p, p + o).alias(out))


def _sum_where(where: Column, value: Column) -> Column:
    """Sum over some rows of the group: NULL if there are none, 0 if all their values are NULL."""
    return F.when(F.count_if(where) > 0, sum_or_zero(F.when(where, value)))


def phyto_carbon(obs: DataFrame, *, key: str, group: str, cells: str, biovolume: str, out: str = "PhytoBiomassCarbon_pg_L") -> DataFrame:
    """Carbon per sample; NULL when any record has no carbon."""
    carbon = F.col(cells) * cell_carbon(F.col(group), F.col(biovolume), F.col(cells))
    return obs.groupBy(key).agg(sum_strict(carbon).alias(out))


def avg_cell_volume(obs: DataFrame, *, key: str, cells: str, biovolume: str, out: str = "AvgCellVol_um3") -> DataFrame:
    """Total biovolume per total cells, over records with a biovolume."""
    rows = obs.filter(F.col(biovolume).isNotNull())
    return rows.groupBy(key).agg(ratio(F.sum(biovolume), sum_strict(F.col(cells))).alias(out))


def richness(obs: DataFrame, *, key: str, name: str, where: Column, out: str, distinct: bool = False) -> DataFrame:
    """Number of records (or of distinct names) per sample."""
    rows = obs.filter(where)
    n = F.count_distinct(F.col(name)) if distinct else F.count(F.lit(1))
    return rows.groupBy(key).agg(n.alias(out))


def diversity(
    obs: DataFrame, *, key: str, name: Column, value: str, groups: Mapping[str, Column], distinct: bool = False,
) -> DataFrame:
    """Richness, Shannon diversity and evenness of several groups in one scan.

    ``groups`` maps a label to the records that count for it; the result has
    ``<label>_richness``, ``<label>_shannon`` and ``<label>_evenness``, NULL in
    samples without such records.  With v the total of a taxon and V that of
    the sample, H = ln V - sum(v ln v) / V, so no share column and no window
    over a sample is needed: records become taxon sums, taxon sums become
    sample sums.
    """
    labels = list(groups)
    any_group = None
    for where in groups.values():
        any_group = where if any_group is None else any_group | where
    flags = {f"_in_{g}": F.lit(True) if len(labels) == 1 else groups[g] for g in labels}
    rows = obs.filter(any_group).withColumns({"_taxon": name, **flags})
    per_taxon = rows.groupBy(key, "_taxon").agg(*[
        agg for g in labels for agg in (
            F.count_if(F.col(f"_in_{g}")).alias(f"_n_{g}"),
            F.sum(F.when(F.col(f"_in_{g}"), F.col(value))).alias(f"_v_{g}"),
        )
    ])
    sums = []
    for g in labels:
        v, n = F.col(f"_v_{g}"), F.col(f"_n_{g}")
        sums += [
            F.sum(F.when(n > 0, F.lit(1)) if distinct else F.when(n > 0, n)).alias(f"{g}_richness"),
            F.sum(F.when(v > 0, v)).alias(f"_V_{g}"),
            F.sum(F.when(v > 0, v * F.log(v))).alias(f"_S_{g}"),
        ]
    per_sample = per_taxon.groupBy(key).agg(*sums)
    out = [F.col(key)]
    for g in labels:
        total = F.col(f"_V_{g}")
        h = F.greatest(F.log(total) - ratio(F.col(f"_S_{g}"), total), F.lit(0.0))
        h = F.when(total > 0, h)
        out += [
            F.col(f"{g}_richness"),
            h.alias(f"{g}_shannon"),
            evenness(h, F.col(f"{g}_richness")).alias(f"{g}_evenness"),
        ]
    return per_sample.select(*out)


def evenness(shannon: Column, n: Column) -> Column:
    """Shannon diversity over ln n; NULL for a single species."""
    return ratio(shannon, F.log(n.cast("double")))


def assemble_indices(base: DataFrame, features: Sequence[DataFrame], key: str) -> DataFrame:
    """Base table with every feature table joined on; one row per base row.

    The features are grouped by the key already, so one shuffle of the base
    serves the whole chain.
    """
    out = base
    for feature in features:
        out = out.join(feature, key, "left")
    return out


def zoo_indices(
    zoo: DataFrame, traits: DataFrame, *, key: str, taxon: str, value: str, copepod: Column,
    size: str = "SIZE_AVE_MM", diet: str = "DIET", complete_over: Sequence[str] | None = None,
) -> DataFrame:
    """Total and copepod abundance, mean copepod length and diet share in one scan."""
    complete_over = list(complete_over or [c for c in zoo.columns])
    known = traits.select(taxon, F.col(size).alias("_size"), F.col(diet).alias("_diet"), F.lit(True).alias("_known"))
    rows = zoo.join(known, taxon, "left").withColumn("_cope", F.coalesce(copepod, F.lit(False)))
    n = F.col(value)
    cope = F.col("_cope")
    sized = cope & F.coalesce("_known", F.lit(False))
    complete = sized & F.col("_diet").isNotNull()
    for c in complete_over:
        complete = complete & F.col(c).isNotNull()
    cc = F.sum(F.when(complete & (F.col("_diet") == CARNIVORE_DIET), n))
    co = F.sum(F.when(complete & (F.col("_diet") != CARNIVORE_DIET), n))
    length = ratio(sum_or_zero(F.when(sized, F.col("_size") * n)), sum_or_zero(F.when(sized, n)))
    return rows.groupBy(key).agg(
        sum_or_zero(n).alias("ZoopAbundance_m3"),
        _sum_where(cope, n).alias("CopeAbundance_m3"),
        F.when(F.count_if(sized) > 0, length).alias("AvgTotalLengthCopepod_mm"),
        ratio(co, co + cc).alias("HerbivoreCarnivoreCopepodRatio"),
    )


def phyto_sums(
    phyto: DataFrame, *, key: str, group: str, cells: str, biovolume: str, unit: str = "L",
    part: Sequence[str] = DIATOM_GROUPS, other: Sequence[str] = (DINOFLAGELLATE,),
) -> DataFrame:
    """Carbon, abundance, diatom share and mean cell volume in one scan."""
    g, c, b = F.col(group), F.col(cells), F.col(biovolume)
    p, o = _sum_where(is_in(g, part), c), _sum_where(is_in(g, other), c)
    sized_cells = F.when(F.count_if(b.isNotNull() & c.isNull()) == 0, F.sum(F.when(b.isNotNull(), c)))
    return phyto.groupBy(key).agg(
        sum_strict(c * cell_carbon(g, b, c)).alias(f"PhytoBiomassCarbon_pg_{unit}"),
        sum_or_zero(c).alias(f"AbundancePhyto_cells_{unit}"),
        ratio(p, p + o).alias("DiatomDinoflagellateRatio"),
        ratio(F.sum(b), sized_cells).alias("AvgCellVol_um3"),
    )
