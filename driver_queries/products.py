"""Product queries: whole chains on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brinedeck.operators.quality import qc_mask, replicate_mean
from brinedeck.plans import matchups, series
from brinedeck.plans.indices import tow_indices
from brinedeck.plans.water_quality import combined_water_quality
from brinedeck.session import shared_folder
from brinedeck.sources.readers import read_grid, read_obs_csv
from brinedeck.sources.sinks import write_grid, write_product
from driver_queries import gridded, indices, roles
from driver_queries.roles import GRID, GRID_AXIS, IDENTIFIED, LAYERS, POINTS, SAMPLES, TAXA, TRAITS, r, table


def water_quality(spark, d):
    line = table(spark, d, "lineitem").withColumns({
        "TripCode": F.col("l_orderkey"), "SampleDepth_m": (F.col("l_linenumber") * 5).cast("string"), "flag": (F.col("l_quantity") % 10).cast("int"),
    })
    keys = ["TripCode", "SampleDepth_m"]
    n = F.col("l_linenumber")
    chemistry = replicate_mean(qc_mask(line.filter(n <= 3).withColumn("nitrate", F.col("l_quantity")), {"nitrate": "flag"}), keys, ["nitrate"])
    pico = replicate_mean(line.filter(n.between(2, 4)).withColumn("pico", F.col("l_discount")), keys, ["pico"])
    pigments = line.filter(n.isin(4, 6)).select(*keys, F.col("l_tax").alias("chla"))
    tss = replicate_mean(line.filter(n.isin(5, 7)).withColumn("tss", F.col("l_tax")), keys, ["tss"])
    ctd = line.select("TripCode", (n * 5 + F.col("l_discount")).alias("Depth_m"), F.col("l_quantity").alias("Temperature_degC"))
    trips = table(spark, d, "orders").select(F.col("o_orderkey").alias("TripCode"), F.col("o_totalprice").alias("Biomass_mgm3"))
    out = combined_water_quality(trips, chemistry, pico, pigments, tss, ctd, {"CTDTemperature": "Temperature_degC"}, code_prefix="N")
    return out.select(*keys, "Biomass_mgm3", "SampleCode", *[r(c).alias(c) for c in ("nitrate", "pico", "chla", "tss", "CTDTemperature")])


def _named(spark, d):
    obs = roles.taxa(spark, d)
    group = F.create_map(*[F.lit(x) for pair in (
        ("SMALL", "Centric diatom"), ("MEDIUM", "Pennate diatom"), ("PROMO", "Dinoflagellate"), ("LARGE", "Cyanobacteria"), ("STANDARD", "Other"), ("ECONOMY", "Ciliate"),
    ) for x in pair])[F.col("grp")]
    return obs.select(
        F.col("trip").alias("Sample"), F.col("taxon").alias("TaxonName"), F.when(F.col("grp") == "SMALL", "COPEPOD").otherwise("NON-COPEPOD").alias("Copepod"),
        group.alias("TaxonGroup"), F.col("genus").alias("Genus"), F.col("species").alias("Species"),
        F.col("cells").alias("ZAbund_m3"), F.col("cells").alias("TaxonCount"), F.col("cells").alias("PAbun_m3"), F.col("biovol").alias("BioVolume_um3m3"),
    )


_DIVERSE = ("Copepod", "Phyto", "Diatom", "Dino")
_EVEN = {"Copepod": "CopepodEvenness", "Phyto": "PhytoEvenness", "Diatom": "DiatomEvenness", "Dino": "DinoflagellateEvenness"}


def sample_indices(spark, d):
    obs = _named(spark, d)
    samples = roles.samples(spark, d).withColumnRenamed("trip", "Sample")
    out = tow_indices(samples, obs, obs, obs, roles.traits(spark, d).withColumnsRenamed({"taxon": "TaxonName", "size": "SIZE_AVE_MM"}))
    return out.select(
        "Sample", "date", "ZoopAbundance_m3", "CopeAbundance_m3", r("AvgTotalLengthCopepod_mm").alias("AvgTotalLengthCopepod_mm"),
        r("HerbivoreCarnivoreCopepodRatio").alias("HerbivoreCarnivoreCopepodRatio"), r("PhytoBiomassCarbon_pg_m3", 3).alias("PhytoBiomassCarbon_pg_m3"),
        "AbundancePhyto_cells_m3", r("DiatomDinoflagellateRatio").alias("DiatomDinoflagellateRatio"), "AvgCellVol_um3",
        *[c for g in _DIVERSE for c in (
            F.col(f"No{g}Species_Sample"), r(f"Shannon{g}Diversity").alias(f"Shannon{g}Diversity"), r(_EVEN[g]).alias(_EVEN[g]))],
    )


def satellite_chain(spark, d):
    """Two grids matched one after the other on the calendar month of the point's date."""
    layers = roles.layers(spark, d).withColumn("period", F.format_string("%02d", F.col("period") + 1))
    pts = roles.points(spark, d).withColumn("Date", F.make_date(F.lit(2015), F.col("period") + 1, F.lit(3)))
    out = matchups.satellite_chain(
        pts.drop("period"), {"temperature": (layers, GRID_AXIS, GRID_AXIS, ["sst"]), "colour": (layers, GRID_AXIS, GRID_AXIS, ["chl"])},
        lon="x", lat="y", resolution="1mNy", res_spat=2,
    )
    return out.select("pid", r("sst_1mNy").alias("sst_1mNy"), r("chl_1mNy").alias("chl_1mNy"))


def climatology_interpolated(spark, d):
    v = F.col("value")
    terms = roles.grid(spark, d).groupBy("lon_idx", "lat_idx").agg(
        F.avg(v).alias("mean"), F.min(v).alias("an_cos"), F.max(v).alias("an_sin"),
        F.avg(F.when(F.col("label") < 5, v)).alias("sa_cos"), F.avg(F.when(F.col("label") >= 5, v)).alias("sa_sin"),
    )
    pts = roles.points(spark, d).withColumn("doy", (F.col("pid") % 366 + 1).cast("int"))
    out = matchups.climatology_at_points(pts, terms, lon="x", lat="y", doy="doy", lon_axis=GRID_AXIS, lat_axis=GRID_AXIS, interpolate=True)
    return out.select("pid", r("value").alias("value"))


def trend_map(spark, d):
    out = series.trend_map(roles.grid(spark, d), (2.0, 6.0, 1.0, 5.0), "vec_id")
    return out.select("lon_idx", "lat_idx", r("slope", 9).alias("slope"))


def coarse_map(spark, d):
    out = series.coarse_map(roles.grid(spark, d), (1.0, 6.0, 1.0, 6.0), k=3)
    return out.select("lon_blk", "lat_blk", r("value").alias("value"))


def region_layers(spark, d):
    """Two region layers on one set of points: nations' shapes, and the same shapes named by region number."""
    edges = gridded.geo.polygon_edges(gridded._vertices(spark, d), ["region"])
    coarse = edges.withColumn("zone", F.concat(F.lit("Z"), F.substr("region", F.lit(8)))).drop("region")
    out = series.tag_regions(roles.points(spark, d), {"a": (edges, ["region"]), "b": (coarse, ["zone"])}, x="x", y="y")
    return out.select("pid", "region", F.col("zone").isNotNull().cast("int").alias("in_zone"))


def csv_product(spark, d):
    """Orders written as a CSV product and read back with null tokens and typed columns."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 3 == 0, "(null)").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 7 == 0, "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )
    path = f"{shared_folder(spark)}/csv_product_{uuid.uuid4().hex}"
    write_product(o, path, "csv")
    return read_obs_csv(spark, path, {
        "trip": ("O_ORDERKEY", "bigint"), "date": ("o_orderdate", "timestamp_ntz"), "priority": ("PRIORITY", "string"), "price": ("Price", "double"),
    })


def grid_product(spark, d):
    """Layers written by product and period; reading one product opens only its folders."""
    path = f"{shared_folder(spark)}/grid_product_{uuid.uuid4().hex}"
    write_grid(roles.layers(spark, d), path)
    return read_grid(spark, path, "sst").groupBy("period").agg(F.count("value").alias("n"), r(F.sum("value")).alias("total"))


QUERIES = {f.__name__: f for f in (
    water_quality, sample_indices, satellite_chain, climatology_interpolated, trend_map, coarse_map, region_layers, csv_product, grid_product,
)}

_NAMED = f"""(select trip, taxon, case when grp = 'SMALL' then 'COPEPOD' else 'NON-COPEPOD' end as cope,
  case grp when 'SMALL' then 'Centric diatom' when 'MEDIUM' then 'Pennate diatom' when 'PROMO' then 'Dinoflagellate' when 'LARGE' then 'Cyanobacteria'
    when 'STANDARD' then 'Other' else 'Ciliate' end as grp, genus, species, cells, biovol from {TAXA})"""
_DIATOM = "grp in ('Centric diatom', 'Pennate diatom')"
_CARBON = """case grp when 'Cyanobacteria' then 0.2 when 'Dinoflagellate' then 0.76 * pow(biovol / nullif(cells, 0), 0.819)
  when 'Ciliate' then 0.22 * pow(biovol / nullif(cells, 0), 0.939) else 0.288 * pow(biovol / nullif(cells, 0), 0.811) end"""


def _diverse(label: str, where: str) -> str:
    return indices._diversity_sql(label, where).replace(f"{label}_richness", f'"No{label}Species_Sample"').replace(
        f"{label}_shannon", f'"Shannon{label}Diversity"').replace(f"{label}_evenness", f'"{_EVEN[label]}"')


_WQ = """line as (select l_orderkey as "TripCode", cast(l_linenumber * 5 as varchar) as "SampleDepth_m", * from lineitem),
  chem as (select "TripCode", "SampleDepth_m", avg(case when cast(l_quantity as integer) % 10 not in (3, 4, 9) then l_quantity end) as nitrate from line where l_linenumber <= 3 group by all),
  pico as (select "TripCode", "SampleDepth_m", avg(l_discount) as pico from line where l_linenumber between 2 and 4 group by all),
  pig as (select "TripCode", "SampleDepth_m", l_tax as chla from line where l_linenumber in (4, 6)),
  tss as (select "TripCode", "SampleDepth_m", avg(l_tax) as tss from line where l_linenumber in (5, 7) group by all),
  ctd as (select "TripCode", "SampleDepth_m", avg(l_quantity) as t from line group by all),
  u as (select "TripCode", "SampleDepth_m" from chem union select "TripCode", "SampleDepth_m" from pico union select "TripCode", "SampleDepth_m" from pig
    union select "TripCode", "SampleDepth_m" from tss union select o_orderkey, 'WC' from orders)"""
_CLIM = f"""g as (select lon_idx, lat_idx, avg(value) as m, min(value) as ac, max(value) as asn, avg(value) filter (label < 5) as sc, avg(value) filter (label >= 5) as ss from {GRID} group by all),
  box as (select *, pid % 366 + 1 as doy, floor(x) as x1, ceil(x) as x2, floor(y) as y1, ceil(y) as y2, x - floor(x) as wx, y - floor(y) as wy from {POINTS}),
  c as (select unnest([1, 1, 2, 2]) as cx, unnest([1, 2, 1, 2]) as cy),
  v as (select pid, cx, cy, wx, wy, m + ac * cos(2 * pi() * doy / 366) + asn * sin(2 * pi() * doy / 366) + sc * cos(4 * pi() * doy / 366) + ss * sin(4 * pi() * doy / 366) as value
    from box cross join c left join g on g.lon_idx = case cx when 1 then x1 else x2 end and g.lat_idx = case cy when 1 then y1 else y2 end)"""

SQL = {
    "water_quality": f"""with {_WQ}
      select u."TripCode", u."SampleDepth_m", o_totalprice as "Biomass_mgm3", 'N' || u."TripCode" || '_' || case when u."SampleDepth_m" = 'WC' then 'WC' else lpad(u."SampleDepth_m", 3, '0') end as "SampleCode",
        round(nitrate, 6) as nitrate, round(pico, 6) as pico, round(chla, 6) as chla, round(tss, 6) as tss, round(t, 6) as "CTDTemperature"
      from u left join orders on o_orderkey = u."TripCode" left join chem using ("TripCode", "SampleDepth_m") left join pico using ("TripCode", "SampleDepth_m")
      left join pig using ("TripCode", "SampleDepth_m") left join tss using ("TripCode", "SampleDepth_m") left join ctd using ("TripCode", "SampleDepth_m")""",
    "sample_indices": f"""with named as {_NAMED},
      tagged as (select *, coalesce(genus, 'NA') || ' ' || split_part(species, ' ', 1) as name from named where {IDENTIFIED}),
      a as ({_diverse('Copepod', "cope = 'COPEPOD'")}), b as ({_diverse('Phyto', "grp <> 'Other'")}), c as ({_diverse('Diatom', _DIATOM)}), e as ({_diverse('Dino', "grp = 'Dinoflagellate'")}),
      z as (select trip, coalesce(sum(cells), 0) as zoo, case when count(*) filter (cope = 'COPEPOD') > 0 then coalesce(sum(cells) filter (cope = 'COPEPOD'), 0) end as copes from named group by 1),
      s as (select trip, coalesce(sum(size * cells), 0) / nullif(coalesce(sum(cells), 0), 0) as len from named join {TRAITS} using (taxon) where cope = 'COPEPOD' group by 1),
      h as (select trip, sum(cells) filter (diet <> 'CC') / nullif(sum(cells) filter (diet <> 'CC') + sum(cells) filter (diet = 'CC'), 0) as hc from named join {TRAITS} using (taxon)
        where cope = 'COPEPOD' and genus is not null and species is not null and cells is not null and biovol is not null group by 1),
      p as (select trip, case when count(*) = count(cells * ({_CARBON})) then sum(cells * ({_CARBON})) end as carbon, coalesce(sum(cells), 0) as total,
          case when count(*) filter ({_DIATOM}) > 0 then coalesce(sum(cells) filter ({_DIATOM}), 0) end as dia,
          case when count(*) filter (grp = 'Dinoflagellate') > 0 then coalesce(sum(cells) filter (grp = 'Dinoflagellate'), 0) end as dino,
          sum(biovol) / nullif(case when count(*) filter (biovol is not null and cells is null) = 0 then sum(cells) filter (biovol is not null) end, 0) as vol
        from named where grp <> 'Other' group by 1)
      select trip as "Sample", date, zoo as "ZoopAbundance_m3", copes as "CopeAbundance_m3", round(len, 6) as "AvgTotalLengthCopepod_mm", round(hc, 6) as "HerbivoreCarnivoreCopepodRatio",
        round(carbon, 3) as "PhytoBiomassCarbon_pg_m3", total as "AbundancePhyto_cells_m3", round(dia / nullif(dia + dino, 0), 6) as "DiatomDinoflagellateRatio", vol as "AvgCellVol_um3",
        a.* exclude (trip), b.* exclude (trip), c.* exclude (trip), e.* exclude (trip)
      from {SAMPLES} left join z using (trip) left join s using (trip) left join h using (trip) left join p using (trip)
      left join a using (trip) left join b using (trip) left join c using (trip) left join e using (trip)""",
    "satellite_chain": gridded._window_sql(-1, 0).replace("sst_1m,", "sst_1mNy,").replace("as chl_1m", "as chl_1mNy").replace("select pid, c.period,", "select pid,").replace(
        "as sst_1mNy", 'as "sst_1mNy"').replace("as chl_1mNy", 'as "chl_1mNy"'),
    "climatology_interpolated": f"""with {_CLIM}
      select pid, round(case when count(value) = 4 then sum(value * (case cx when 1 then 1 - wx else wx end) * (case cy when 1 then 1 - wy else wy end)) end, 6) as value from v group by pid""",
    "trend_map": f"select lon_idx, lat_idx, round(regr_slope(value, vec_id), 9) as slope from {GRID} where lon between 2 and 6 and lat between 1 and 5 group by 1, 2",
    "coarse_map": f"select lon_idx // 3 as lon_blk, lat_idx // 3 as lat_blk, round(avg(value), 6) as value from {GRID} where lon between 1 and 6 and lat between 1 and 6 group by 1, 2",
    "region_layers": f"with {gridded._EDGES} select pid, region, case when region is null then 0 else 1 end as in_zone from tagged",
    "csv_product": """select o_orderkey as trip, o_orderdate as date, case when o_orderkey % 3 <> 0 then o_orderpriority end as priority,
        case when o_orderkey % 7 <> 0 then o_totalprice end as price from orders""",
    "grid_product": f"select period, count(value) as n, round(sum(value), 6) as total from {LAYERS} where product = 'sst' group by 1",
}
