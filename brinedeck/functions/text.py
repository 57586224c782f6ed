"""Text expressions: codes, names and the species-quality test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brinedeck.functions.missing import paste


def pad_left(value: Column, width: int, fill: str = "0") -> Column:
    """Left-pad without ever cutting longer text."""
    return F.when(F.length(value) >= width, value).otherwise(F.lpad(value, width, fill))


def first_word(value: Column) -> Column:
    return F.split_part(value, F.lit(" "), F.lit(1))


def path_part(value: Column, n: int) -> Column:
    """n-th part (from 1) of a slash-separated path."""
    return F.try_element_at(F.split(value, "/"), F.lit(n))


def time_of_day(ts: Column) -> Column:
    """Last eight characters of the printed timestamp."""
    return F.date_format(ts, "HH:mm:ss")


def station_of_trip(trip: Column) -> Column:
    return F.substring(trip, 1, 3)


def station_of_cast(code: Column) -> Column:
    return F.substring(code, 4, 3)


def sample_code(trip: Column, depth: Column, prefix: str = "NRS") -> Column:
    """``<prefix><trip>_<depth padded to three digits>``, or ``_WC`` for the water column."""
    return paste(prefix, trip, "_", F.when(depth == "WC", depth).otherwise(pad_left(depth, 3)))


def cast_code(site: Column, ts: Column, with_time: tuple[str, ...] = ("NRSDAR",)) -> Column:
    """Site and date; sites sampled more than once a day also carry the time."""
    return F.when(
        site.isin(*with_time), F.concat(site, F.date_format(ts, "yyyyMMdd_HH:mm"))
    ).otherwise(F.concat(site, F.date_format(ts, "yyyyMMdd")))


def genus_species(genus: Column, species: Column) -> Column:
    """``genus species``; a missing part prints as ``NA``."""
    return paste(genus, " ", species)


def binomial(genus: Column, species: Column) -> Column:
    """Genus and the first word of the species, which bins species complexes."""
    return paste(genus, " ", first_word(species))


def is_identified_species(
    species: Column, *, allow_slash: bool = True, allow_empty: bool = True, allow_grp: bool = False,
) -> Column:
    """Identified to species: not ``spp.``, not NULL, no ``cf.`` or ``grp`` mark.

    ``cf.`` is a regular expression, so its dot stands for any character.
    """
    ok = (species != "spp.") & ~species.rlike("cf.")
    if not allow_grp:
        ok = ok & ~F.contains(species, F.lit("grp"))
    if not allow_slash:
        ok = ok & ~F.contains(species, F.lit("/"))
    if not allow_empty:
        ok = ok & (species != "")
    return F.coalesce(ok, F.lit(False))
