"""Taxon table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.fixed_values import PLACEHOLDER
from brinedeck.functions.text import binomial, first_word, is_identified_species
from brinedeck.operators import taxa as op
from driver_queries import roles
from driver_queries.roles import IDENTIFIED, LOG, SAMPLES, TAXA


def _log(spark, d):
    return roles.change_log(spark, d).withColumnsRenamed({"taxon": "TaxonName", "start": "StartDate", "parent": "ParentName"})


def _obs(spark, d):
    return roles.taxa(spark, d).withColumnRenamed("taxon", "TaxonName")


def change_log_split(spark, d):
    """Records of renamed and of unchanged taxa, by level."""
    log, obs = _log(spark, d), _obs(spark, d)
    parts = []
    for level in ("genus", "name"):
        changed = op.changed_in_log(log, level)
        for inside, rows in ((1, op.in_change_log(obs, changed)), (0, op.not_in_change_log(obs, changed))):
            parts.append(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(level).alias("level"), F.lit(inside).alias("inside"), "grp", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def group_totals(spark, d):
    return op.group_totals(
        roles.samples(spark, d), _obs(spark, d), key="trip", group="grp", value="cells",
        exclude=("ECONOMY", "STANDARD"), placeholder=PLACEHOLDER["phyto_group"],
    ).select("trip", "date", "grp", "cells")


def _presence(spark, d, obs, *, level, value, placeholder, where=None):
    out = op.apply_change_log(
        roles.samples(spark, d), obs, _log(spark, d), level=level, key="trip", date="date", name="name", value=value,
        placeholder=PLACEHOLDER[placeholder], plain_where=where, affected_where=where,
    )
    return out.withColumnRenamed(value, "value")


def genus_long(spark, d):
    return _presence(spark, d, _obs(spark, d).withColumn("name", F.col("genus")), level="genus", value="cells", placeholder="genus")


def genus_biovolume_long(spark, d):
    obs = _obs(spark, d).withColumn("name", F.col("genus"))
    out = _presence(spark, d, obs, level="genus", value="biovol", placeholder="genus")
    return out.select("trip", "date", "name", F.round("value", 2).alias("value"))


def _counts(spark, d, obs, *, placeholder, where=None):
    """Samples by state of each name and year, without a row per sample and name."""
    samples = roles.samples(spark, d).withColumn("year", F.year("date").cast("bigint"))
    return op.presence_counts(
        samples, obs, _log(spark, d), level="name", key="trip", date="date", name="name", value="cells",
        placeholder=PLACEHOLDER[placeholder], by=["year"], plain_where=where, affected_where=where,
    )


def species_long(spark, d):
    obs = _obs(spark, d).withColumn("name", F.col("TaxonName"))
    return _counts(spark, d, obs, placeholder="species", where=is_identified_species(F.col("species")))


def _group_species(spark, d, where, placeholder):
    ok = is_identified_species(F.col("species"), allow_slash=False, allow_empty=False)
    obs = _obs(spark, d).filter(where & ok).withColumn("name", binomial(first_word(F.col("TaxonName")), F.col("species")))
    return _counts(spark, d, obs, placeholder=placeholder)


def copepod_long(spark, d):
    return _group_species(spark, d, F.col("grp") == "SMALL", "copepod")


def noncopepod_long(spark, d):
    return _group_species(spark, d, F.col("grp") != "SMALL", "noncopepod")


def ids_long(spark, d):
    return op.ids_long(
        roles.samples(spark, d), _obs(spark, d), key="trip", taxon="TaxonName", genus="genus", species="species", value="cells",
    ).select("trip", "date", "TaxonName", "cells")


def raw_long(spark, d):
    return op.raw_long(roles.samples(spark, d), _obs(spark, d), key="trip", name="TaxonName", value="cells", placeholder=PLACEHOLDER["raw"])


GROUP_NAMES = ("Ciliate", "LARGE", "MEDIUM", "PROMO", "SMALL")


def taxon_matrix(spark, d):
    long = group_totals(spark, d)
    return op.to_matrix(long, ["trip", "date"], "grp", "cells", names=GROUP_NAMES, drop_names=("Ciliate",))


def genus_matrix(spark, d):
    long = genus_long(spark, d)
    return op.to_matrix(long, ["trip", "date"], "name", "value", names=[f"Brand#{i}" for i in range(1, 26)])


def taxon_totals(spark, d):
    return op.taxon_totals(_obs(spark, d), "TaxonName", "cells")


def drop_zero_taxa(spark, d):
    obs = _obs(spark, d).withColumn("cells", F.when(F.col("TaxonName").startswith("red"), F.lit(0.0)).otherwise(F.col("cells")))
    return op.drop_zero_taxa(obs, "TaxonName", "cells").groupBy("TaxonName").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    change_log_split, group_totals, genus_long, genus_biovolume_long, species_long, copepod_long, noncopepod_long,
    ids_long, raw_long, taxon_matrix, genus_matrix, taxon_totals, drop_zero_taxa,
)}

_GENUS_CHANGED = "split_part(taxon, ' ', 1) <> split_part(parent, ' ', 1)"
_NAME_CHANGED = "taxon <> parent"


def _presence_sql(changed: str, name: str, value: str, placeholder: str, where: str) -> str:
    return f"""with obs as (select trip, taxon, {name} as name, {value} as v from {TAXA} where {where}),
      log as {LOG}, changed as (select taxon from log where {changed}), smp as {SAMPLES},
      plain as (select trip, name, coalesce(sum(v), 0) as v from obs where taxon not in (select taxon from changed) and name <> '' group by all),
      p as (select trip, date, coalesce(name, '{PLACEHOLDER[placeholder]}') as name, coalesce(v, 0) as v from smp left join plain using (trip)),
      aff as (select trip, start, name, coalesce(sum(v), 0) as v from obs join log using (taxon) where taxon in (select taxon from changed) and name <> '' group by all),
      d0 as (select name, start as d0 from aff qualify row_number() over (partition by name order by trip, start) = 1),
      dense as (select s.trip, s.date, d0.name,
          case when coalesce(a.start, d0) > s.date then -999.0 when a.v is null and coalesce(a.start, d0) < s.date then 0 else a.v end as v
        from smp s cross join d0 left join aff a on a.trip = s.trip and a.name = d0.name),
      parts as (select trip, date, name, sum(v) as v from p group by all
        union all select trip, date, name, case when count(*) = count(v) then sum(v) end as v from dense group by all),
      long as (select trip, date, name, case when count(*) = count(v) then max(v) end as value from parts group by all)"""


_BY_YEAR = """ select name, year(date) as year, count(*) filter (value = -999) as n_not_looked_for, count(*) filter (value = 0) as n_absent,
      count(*) filter (value is null) as n_unknown, count(*) filter (value > 0) as n_found, coalesce(sum(value) filter (value > 0), 0) as total
    from long group by 1, 2"""
_BINOMIAL = "split_part(taxon, ' ', 1) || ' ' || split_part(species, ' ', 1)"
_STRICT = f"{IDENTIFIED} and species not like '%/%' and species <> ''"
_TOTALS = f"""select s.trip, s.date, coalesce(grp, 'Ciliate') as grp, coalesce(v, 0) as cells from {SAMPLES} s
  left join (select trip, grp, coalesce(sum(cells), 0) as v from {TAXA} where grp not in ('ECONOMY', 'STANDARD') group by all) using (trip)"""
_GENUS = _presence_sql(_GENUS_CHANGED, "genus", "cells", "genus", "true")

SQL = {
    "change_log_split": " union all ".join(
        f"select '{level}' as level, {inside} as inside, grp, count(*) as n from {TAXA} where taxon {'in' if inside else 'not in'} (select taxon from {LOG} where {cond}) group by grp"
        for level, cond in (("genus", _GENUS_CHANGED), ("name", _NAME_CHANGED)) for inside in (1, 0)
    ),
    "group_totals": _TOTALS,
    "genus_long": _GENUS + " select trip, date, name, value from long",
    "genus_biovolume_long": _presence_sql(_GENUS_CHANGED, "genus", "biovol", "genus", "true") + " select trip, date, name, round(value, 2) as value from long",
    "species_long": _presence_sql(_NAME_CHANGED, "taxon", "cells", "species", IDENTIFIED) + _BY_YEAR,
    "copepod_long": _presence_sql(_NAME_CHANGED, _BINOMIAL, "cells", "copepod", f"grp = 'SMALL' and {_STRICT}") + _BY_YEAR,
    "noncopepod_long": _presence_sql(_NAME_CHANGED, _BINOMIAL, "cells", "noncopepod", f"grp <> 'SMALL' and {_STRICT}") + _BY_YEAR,
    "ids_long": f"""select trip, date, "TaxonName", coalesce(sum(cells), 0) as cells from (
        select s.trip, s.date, case when genus is null then taxon else genus || ' ' || coalesce(species, 'NA') end as "TaxonName", cells
        from {SAMPLES} s left join {TAXA} using (trip)) group by all""",
    "raw_long": f"""select s.trip, s.date, coalesce(taxon, 'No taxa found') as "TaxonName", cells from {SAMPLES} s left join {TAXA} using (trip)""",
    "taxon_matrix": f"select trip, date, " + ", ".join(
        f"case when count(*) filter (grp = '{n}') = 0 then 0 else sum(cells) filter (grp = '{n}') end as \"{n}\"" for n in GROUP_NAMES if n != "Ciliate"
    ) + f" from ({_TOTALS}) group by trip, date",
    "genus_matrix": _GENUS + " select trip, date, " + ", ".join(
        f"case when count(*) filter (name = 'Brand#{i}') = 0 then 0 else sum(value) filter (name = 'Brand#{i}') end as \"Brand#{i}\"" for i in range(1, 26)
    ) + " from long group by trip, date",
    "taxon_totals": f'select taxon as "TaxonName", coalesce(sum(cells), 0) as total from {TAXA} group by 1',
    "drop_zero_taxa": f"""select taxon as "TaxonName", count(*) as n from {TAXA} where taxon not like 'red%' group by 1 having coalesce(sum(cells), 0) <> 0""",
}
