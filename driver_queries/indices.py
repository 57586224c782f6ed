"""Index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.functions.ocean import cell_carbon
from brinedeck.functions.text import binomial, is_identified_species
from brinedeck.operators import indices as op
from driver_queries import roles
from driver_queries.roles import IDENTIFIED, SAMPLES, TAXA, TRAITS, r



def _groups():
    everything = {"all": _identified()}
    return everything | {
        "diatom": F.col("grp").isin("SMALL", "MEDIUM") & _identified(), "dino": (F.col("grp") == "PROMO") & _identified(),
    }


def _identified():
    return is_identified_species(F.col("species"))


def shannon_evenness(spark, d):
    found = op.diversity(
        roles.taxa(spark, d), key="trip", name=binomial(F.col("genus"), F.col("species")), value="cells",
        groups={"sp": _identified()},
    )
    out = roles.samples(spark, d).select("trip").join(found, "trip", "left")
    return out.select("trip", "sp_richness", r("sp_shannon").alias("sp_shannon"), r("sp_evenness").alias("sp_evenness"))


def diversity_by_group(spark, d):
    found = op.diversity(
        roles.taxa(spark, d), key="trip", name=binomial(F.col("genus"), F.col("species")), value="cells",
        groups=_groups(),
    )
    return found.select("trip", *[
        c for g in _groups() for c in (F.col(f"{g}_richness"), r(f"{g}_shannon").alias(f"{g}_shannon"), r(f"{g}_evenness").alias(f"{g}_evenness"))
    ])


def richness(spark, d):
    return op.richness(roles.taxa(spark, d), key="trip", name="taxon", where=_identified(), out="n_species")


def richness_distinct(spark, d):
    return op.richness(roles.taxa(spark, d), key="trip", name="taxon", where=_identified(), out="n_species", distinct=True)


def total_abundance(spark, d):
    obs = roles.taxa(spark, d)
    totals = op.total_abundance(obs, "trip", "cells", "total")
    cope = op.total_abundance(obs, "trip", "cells", "small_total", F.col("grp") == "SMALL")
    out = op.assemble_indices(roles.samples(spark, d).select("trip"), [totals, cope], "trip")
    return out.select("trip", F.coalesce("total", F.lit(0.0)).alias("total"), "small_total")


def weighted_mean_size(spark, d):
    out = op.weighted_mean_size(
        roles.taxa(spark, d).filter("grp = 'SMALL'"), roles.traits(spark, d), key="trip", taxon="taxon", value="cells", size="size", out="mean_size",
    )
    return out.select("trip", r("mean_size").alias("mean_size"))


def diet_ratio(spark, d):
    out = op.diet_ratio(roles.taxa(spark, d), roles.traits(spark, d), key="trip", taxon="taxon", value="cells", out="ratio")
    return out.select("trip", r("ratio").alias("ratio"))


def diatom_dino_ratio(spark, d):
    out = op.group_share(
        roles.taxa(spark, d), key="trip", group="grp", value="cells", part=("SMALL", "MEDIUM"), other=("PROMO",), out="ratio",
    )
    return out.select("trip", r("ratio").alias("ratio"))


def _carbon_groups(obs):
    renamed = {"PROMO": "Dinoflagellate", "SMALL": "Ciliate", "LARGE": "Cyanobacteria"}
    group = F.col("grp")
    for code, name in renamed.items():
        group = F.when(F.col("grp") == code, name).otherwise(group)
    return obs.withColumn("grp", group)


def phyto_carbon(spark, d):
    out = op.phyto_carbon(_carbon_groups(roles.taxa(spark, d)), key="trip", group="grp", cells="cells", biovolume="biovol", out="carbon")
    return out.select("trip", r("carbon", 3).alias("carbon"))


def cell_carbon_by_group(spark, d):
    obs = _carbon_groups(roles.taxa(spark, d))
    carbon = cell_carbon(F.col("grp"), F.col("biovol"), F.col("cells"))
    return obs.groupBy("grp").agg(r(F.avg(carbon), 3).alias("mean_carbon"), F.count(carbon).alias("n"))


def avg_cell_volume(spark, d):
    out = op.avg_cell_volume(roles.taxa(spark, d), key="trip", cells="cells", biovolume="biovol", out="volume")
    return out.select("trip", "volume")


def assemble_indices(spark, d):
    obs = roles.taxa(spark, d)
    features = [
        op.total_abundance(obs, "trip", "cells", "total"),
        op.total_abundance(obs, "trip", "cells", "small_total", F.col("grp") == "SMALL"),
        op.weighted_mean_size(obs, roles.traits(spark, d), key="trip", taxon="taxon", value="cells", size="size", out="mean_size"),
        op.group_share(obs, key="trip", group="grp", value="cells", part=("SMALL", "MEDIUM"), other=("PROMO",), out="ratio"),
        op.avg_cell_volume(obs, key="trip", cells="cells", biovolume="biovol", out="volume"),
        op.diversity(obs, key="trip", name=binomial(F.col("genus"), F.col("species")), value="cells", groups={"sp": _identified()}),
    ]
    out = op.assemble_indices(roles.samples(spark, d), features, "trip")
    return out.select(
        "trip", "date", "total", "small_total", r("mean_size").alias("mean_size"), r("ratio").alias("ratio"),
        "volume", "sp_richness", r("sp_shannon").alias("sp_shannon"), r("sp_evenness").alias("sp_evenness"),
    )


QUERIES = {f.__name__: f for f in (
    shannon_evenness, diversity_by_group, richness, richness_distinct, total_abundance, weighted_mean_size, diet_ratio,
    diatom_dino_ratio, phyto_carbon, cell_carbon_by_group, avg_cell_volume, assemble_indices,
)}


def _diversity_sql(prefix: str, where: str) -> str:
    return f"""
  select trip, n as {prefix}_richness, round(h, 6) as {prefix}_shannon, round(h / nullif(ln(n), 0), 6) as {prefix}_evenness
  from (
    select c.trip, any_value(c.n) as n, case when any_value(c.tot) > 0 then coalesce(-sum(case when v > 0 then v / c.tot * ln(v / c.tot) end), 0) end + 0.0 as h
    from (select trip, name, sum(cells) as v from tagged where {where} group by trip, name) s
    join (select trip, cast(count(*) as bigint) as n, sum(cells) as tot from tagged where {where} group by trip) c using (trip)
    group by c.trip
  )"""


_TAGGED = f"tagged as (select *, coalesce(genus, 'NA') || ' ' || split_part(species, ' ', 1) as name from {TAXA} where {IDENTIFIED})"
_CARBON_SQL = """case when grp = 'LARGE' then 0.2 when grp = 'PROMO' then 0.76 * pow(biovol / nullif(cells, 0), 0.819)
  when grp = 'SMALL' then 0.22 * pow(biovol / nullif(cells, 0), 0.939) else 0.288 * pow(biovol / nullif(cells, 0), 0.811) end"""
_MEAN_SIZE = f"""select trip, coalesce(sum(size * cells), 0) / nullif(coalesce(sum(cells), 0), 0) as mean_size
  from {TAXA} join {TRAITS} using (taxon)"""
_RATIO = f"""select trip, p / nullif(p + o, 0) as ratio from (
    select trip, case when count(*) filter (grp in ('SMALL', 'MEDIUM')) > 0 then coalesce(sum(cells) filter (grp in ('SMALL', 'MEDIUM')), 0) end as p,
           case when count(*) filter (grp = 'PROMO') > 0 then coalesce(sum(cells) filter (grp = 'PROMO'), 0) end as o
    from {TAXA} where grp in ('SMALL', 'MEDIUM', 'PROMO') group by trip)"""
_VOLUME = f"""select trip, sum(biovol) / nullif(case when count(*) = count(cells) then sum(cells) end, 0) as volume
  from {TAXA} where biovol is not null group by trip"""

SQL = {
    "shannon_evenness": f"""with {_TAGGED}, h as ({_diversity_sql('sp', 'true')})
      select trip, sp_richness, sp_shannon, sp_evenness from (select trip from {SAMPLES}) left join h using (trip)""",
    "diversity_by_group": f"""with {_TAGGED}, a as ({_diversity_sql('all', 'true')}),
      b as ({_diversity_sql('diatom', "grp in ('SMALL', 'MEDIUM')")}), c as ({_diversity_sql('dino', "grp = 'PROMO'")})
      select * from a left join b using (trip) left join c using (trip)""",
    "richness": f"select trip, count(*) as n_species from {TAXA} where {IDENTIFIED} group by trip",
    "richness_distinct": f"select trip, count(distinct taxon) as n_species from {TAXA} where {IDENTIFIED} group by trip",
    "total_abundance": f"""select s.trip, coalesce(sum(cells), 0) as total,
        case when count(*) filter (grp = 'SMALL') > 0 then coalesce(sum(cells) filter (grp = 'SMALL'), 0) end as small_total
      from {SAMPLES} s left join {TAXA} o using (trip) group by s.trip""",
    "weighted_mean_size": f"select trip, round(mean_size, 6) as mean_size from ({_MEAN_SIZE} where grp = 'SMALL' group by trip)",
    "diet_ratio": f"""select trip, round(co / nullif(co + cc, 0), 6) as ratio from (
        select trip, sum(cells) filter (diet = 'CC') as cc, sum(cells) filter (diet <> 'CC') as co
        from {TAXA} join {TRAITS} using (taxon)
        where genus is not null and species is not null and cells is not null and biovol is not null group by trip)""",
    "diatom_dino_ratio": f"select trip, round(ratio, 6) as ratio from ({_RATIO})",
    "phyto_carbon": f"""select trip, round(case when count(*) = count(c) then sum(c) end, 3) as carbon
      from (select trip, cells * ({_CARBON_SQL}) as c from {TAXA}) group by trip""",
    "cell_carbon_by_group": f"""select case grp when 'PROMO' then 'Dinoflagellate' when 'SMALL' then 'Ciliate' when 'LARGE' then 'Cyanobacteria' else grp end as grp,
        round(avg(c), 3) as mean_carbon, count(c) as n from (select grp, {_CARBON_SQL} as c from {TAXA}) group by 1""",
    "avg_cell_volume": f"select trip, volume from ({_VOLUME})",
    "assemble_indices": f"""with {_TAGGED}, h as ({_diversity_sql('sp', 'true')}),
      t as (select trip, coalesce(sum(cells), 0) as total, case when count(*) filter (grp = 'SMALL') > 0 then coalesce(sum(cells) filter (grp = 'SMALL'), 0) end as small_total from {TAXA} group by trip)
      select trip, date, total, small_total, round(mean_size, 6) as mean_size, round(ratio, 6) as ratio, volume,
             sp_richness, sp_shannon, sp_evenness
      from {SAMPLES} left join t using (trip) left join ({_MEAN_SIZE} group by trip) m using (trip)
      left join ({_RATIO}) q using (trip) left join ({_VOLUME}) v using (trip) left join h using (trip)""",
}
