"""Vertical profile queries: line items of a part as a cast."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.functions.ocean import reference_depth
from brinedeck.operators import profile as op
from driver_queries import roles
from driver_queries.roles import table


def _profile(spark, d):
    line = table(spark, d, "lineitem")
    n = F.col("l_linenumber")
    return line.select(
        F.concat(F.when(F.col("l_partkey") % 4 == 0, "DAR").when(F.col("l_partkey") % 4 == 1, "YON").otherwise("MAI"), F.col("l_partkey").cast("string")).alias("trip"),
        (F.datediff("l_shipdate", F.lit("1995-01-01")) % 997 / 5.0).alias("depth"),
        F.when(n != 7, F.col("l_quantity")).alias("t"),
        F.when(n != 6, F.col("l_discount")).alias("s"),
        F.when((n != 5) | (F.col("l_partkey") % 3 == 0), F.col("l_tax")).alias("chl"),
    )


def mixed_layer(spark, d):
    return op.mixed_layer(
        _profile(spark, d), trip="trip", depth="depth", temperature="t", salinity="s", chlorophyll="chl",
        ref_depth=reference_depth(F.col("trip")),
    )


def chlorophyll_maxima(spark, d):
    return op.chlorophyll_maxima(_profile(spark, d), trip="trip", depth="depth", chlorophyll="chl", ref_depth=reference_depth(F.col("trip")))


def reference_sample(spark, d):
    out = op.reference_sample(_profile(spark, d), trip="trip", depth="depth", measures=["t", "s"], ref_depth=reference_depth(F.col("trip")))
    return out.select("trip", F.col("_ref.depth").alias("depth"), F.col("_ref.t").alias("t"), F.col("_ref.s").alias("s"))


QUERIES = {f.__name__: f for f in (mixed_layer, chlorophyll_maxima, reference_sample)}

_PROFILE = """p as (select case l_partkey % 4 when 0 then 'DAR' when 1 then 'YON' else 'MAI' end || l_partkey as trip,
    case when l_partkey % 4 < 2 then 5 else 10 end as rd, date_diff('day', date '1995-01-01', cast(l_shipdate as date)) % 997 / 5.0 as depth,
    case when l_linenumber <> 7 then l_quantity end as t, case when l_linenumber <> 6 then l_discount end as s,
    case when l_linenumber <> 5 or l_partkey % 3 = 0 then l_tax end as chl from lineitem),
  ref as (select * from p qualify row_number() over (partition by trip order by abs(depth - rd), depth, t nulls first, s nulls first) = 1),
  below as (select p.*, abs(p.t - (ref.t - 0.4)) as gt, abs(p.s - (ref.s - 0.03)) as gs from p join ref using (trip) where p.depth > ref.depth),
  top as (select trip, case when count(*) = count(chl) then max(chl) end as m from below group by trip)"""

SQL = {
    "reference_sample": f"with {_PROFILE} select trip, depth, t, s from ref",
    "mixed_layer": f"""with {_PROFILE},
      a as (select trip, depth from below qualify row_number() over (partition by trip order by gt nulls last, depth) = 1),
      b as (select trip, depth from below qualify row_number() over (partition by trip order by gs nulls last, depth) = 1),
      c as (select trip, min(below.depth) as depth from below join top using (trip) where chl = m and chl > 0 group by trip)
      select ref.trip, a.depth as "MLD_temp", b.depth as "MLD_sal", c.depth as "DCM" from ref left join a using (trip) left join b using (trip) left join c using (trip)""",
    "chlorophyll_maxima": f"""with {_PROFILE.replace('t nulls first, s nulls first', 'chl nulls first')}
      select ref.trip, c.depth as "DCM" from ref left join (select distinct trip, below.depth from below join top using (trip) where chl = m and chl > 0) c using (trip)""",
}
