"""Community queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.operators import community as op
from driver_queries import roles
from driver_queries.roles import COMMUNITY, r, table


def wisconsin(spark, d):
    out = op.wisconsin(roles.community(spark, d), key="site", taxon="taxon", value="n")
    return out.select("site", "taxon", r("n", 9).alias("share"))


def bray_curtis(spark, d):
    out = op.bray_curtis(roles.community(spark, d), key="site", taxon="taxon", value="n")
    return out.select("a", "b", r("dissimilarity", 9).alias("dissimilarity"))


def bray_curtis_transformed(spark, d):
    shares = op.wisconsin(roles.community(spark, d), key="site", taxon="taxon", value="n")
    out = op.bray_curtis(shares, key="site", taxon="taxon", value="n", tile=8)
    return out.select("a", "b", r("dissimilarity", 9).alias("dissimilarity"))


def community_selection(spark, d):
    """Samples of some years, without the taxa that have nothing then."""
    rows = roles.community(spark, d).withColumn("n", F.when(F.col("taxon").endswith("7"), F.lit(0.0)).otherwise(F.col("n")))
    chosen = op.sqrt_transform(op.community(rows, taxon="taxon", value="n", where=F.col("year").between(1996, 1999)), "n")
    return chosen.groupBy("taxon").agg(r(F.sum("n"), 4).alias("root_total"))


def _scores(spark, d):
    e = table(spark, d, "embeddings")
    at = lambda i: F.col("embedding")[i].cast("double")
    return e.select(
        "vec_id", at(0).alias("u"), at(1).alias("v"), (at(0) * 2 - at(1) + at(2)).alias("lat"), at(3).alias("sst"),
        F.when(F.col("vec_id") % 50 != 7, at(4) + at(1)).alias("chl"), F.col("label"),
    )


VARIABLES = ("lat", "sst", "chl")


def env_fit(spark, d):
    out = op.env_fit(_scores(spark, d), axes=("u", "v"), variables=VARIABLES)
    return out.select("variable", *[r(c).alias(c) for c in ("r2", "axis1", "axis2")])


def factor_fit(spark, d):
    out = op.factor_fit(_scores(spark, d), axes=("u", "v"), factor="label")
    return out.select("label", "n", *[r(c).alias(c) for c in ("axis1", "axis2", "r2")])


def env_fit_test(spark, d):
    out = op.env_fit_test(_scores(spark, d), key="vec_id", axes=("u", "v"), variables=VARIABLES, permutations=1000)
    return out.select("variable", r("r2").alias("r2"), "hits", r("p_value").alias("p_value"))


def factor_fit_test(spark, d):
    out = op.factor_fit_test(_scores(spark, d), key="vec_id", axes=("u", "v"), factor="label", permutations=1000)
    return out.select(r("r2").alias("r2"), "hits", r("p_value").alias("p_value"))


QUERIES = {f.__name__: f for f in (wisconsin, bray_curtis, bray_curtis_transformed, community_selection, env_fit, factor_fit, env_fit_test, factor_fit_test)}

_CELLS = f"cells as (select site, taxon, sum(n) as n from {COMMUNITY} group by all)"
_SHARES = f"""{_CELLS}, roots as (select site, taxon, sqrt(n) as n from cells), tops as (select site, taxon, n / max(n) over (partition by taxon) as n from roots),
  shares as (select site, taxon, n / sum(n) over (partition by site) as n from tops)"""
_BRAY = """, tot as (select site, sum(n) as s from {t} group by 1),
  pairs as (select x.site as a, y.site as b, x.s + y.s as total from tot x join tot y on x.site < y.site),
  low as (select x.site as a, y.site as b, sum(least(x.n, y.n)) as m from {t} x join {t} y on x.taxon = y.taxon and x.site < y.site group by 1, 2)
  select a, b, round(1 - 2 * coalesce(m, 0) / total, 9) as dissimilarity from pairs left join low using (a, b)"""
_SCORES = """scores as (select vec_id, label, cast(embedding[1] as double) as u, cast(embedding[2] as double) as v,
    cast(embedding[1] as double) * 2 - cast(embedding[2] as double) + cast(embedding[3] as double) as lat, cast(embedding[4] as double) as sst,
    case when vec_id % 50 <> 7 then cast(embedding[5] as double) + cast(embedding[2] as double) end as chl from embeddings),
  full_rows as (select * from scores where chl is not null),
  long as (select vec_id, u, v, unnest(['lat', 'sst', 'chl']) as variable, unnest([lat, sst, chl]) as z from full_rows)"""


def _fit_sql(source: str, by: str) -> str:
    return f"""(select {by}variable, (b1 * cu + b2 * cv) / zz as r2, b1 / sqrt(b1 * b1 + b2 * b2) as axis1, b2 / sqrt(b1 * b1 + b2 * b2) as axis2 from (
      select *, (cu * vv - cv * uv) / (uu * vv - uv * uv) as b1, (cv * uu - cu * uv) / (uu * vv - uv * uv) as b2 from (
      select {by}variable, var_pop(u) as uu, var_pop(v) as vv, covar_pop(u, v) as uv, covar_pop(u, z) as cu, covar_pop(v, z) as cv, var_pop(z) as zz from {source} group by all)))"""


def _permuted_sql(source: str) -> str:
    """Ranked rows of ``source`` and where each of 1000 bijections sends a rank: rounds on a rectangle, again from places left over."""
    turns = []
    for turn in range(op.ROUNDS):
        mixed = lambda c, t: f"(({c} * {op.MIX_RANK} + k * {op.MIX_DRAW} + {t * op.MIX_ROUND}) % {op.MIX_PRIME})"  # noqa: B023, E731
        x, y = mixed("y", 2 * turn), mixed("x", 2 * turn + 1)
        turns += [f"select k, rank, a, b, n, (x + ({x} * {x}) % {op.MIX_PRIME}) % a as x, y from", f"select k, rank, a, b, n, x, (y + ({y} * {y}) % {op.MIX_PRIME}) % b as y from"]
    step = lambda rows: "".join(f"{t} (" for t in reversed(turns)) + rows + ")" * len(turns)
    return f"""ranked as materialized (select *, row_number() over (order by md5(cast(vec_id as varchar)), vec_id) - 1 as rank from {source}),
      size as (select count(*) as n, cast(floor(sqrt(count(*))) as bigint) as s from ranked),
      sides as materialized (select n, a, cast(ceil(n / a) as bigint) as b from (select n, unnest(range((s + 1) // 2, 2 * s + 1)) as a from size) order by (a - n % a) % a, a limit 1),
      walk as (select k, rank, a, b, n, x * b + y as slot from ({step("select k, rank, a, b, n, rank // b as x, rank % b as y from ranked, sides, range(1, 1001) t(k)")})
        union all select k, rank, a, b, n, x * b + y from ({step("select k, rank, a, b, n, slot // b as x, slot % b as y from walk where slot >= n")})),
      sent as (select k, rank, slot from walk where slot < n)"""


SQL = {
    "wisconsin": f"with {_SHARES} select site, taxon, round(n, 9) as share from shares",
    "bray_curtis": f"with {_CELLS}{_BRAY.format(t='cells')}",
    "bray_curtis_transformed": f"with {_SHARES}{_BRAY.format(t='shares')}",
    "community_selection": f"""select taxon, round(sum(sqrt(n)), 4) as root_total from (select year, taxon, case when taxon like '%7' then 0 else n end as n from {COMMUNITY})
      where year between 1996 and 1999 group by 1 having sum(n) <> 0""",
    "env_fit": f"with {_SCORES} select variable, round(r2, 6) as r2, round(axis1, 6) as axis1, round(axis2, 6) as axis2 from {_fit_sql('long', '')}",
    "factor_fit": f"""with {_SCORES}, t as (select var_pop(u) + var_pop(v) as total from scores),
      l as (select label, count(*) as n, avg(u) as axis1, avg(v) as axis2, var_pop(u) + var_pop(v) as w from scores group by 1),
      f as (select 1 - sum(n * w) / sum(n) / any_value(total) as r2 from l, t)
      select label, n, round(axis1, 6) as axis1, round(axis2, 6) as axis2, round(r2, 6) as r2 from l, f""",
    "env_fit_test": f"""with recursive {_SCORES}, {_permuted_sql("full_rows")},
      perm as (select k, s.u, s.v, unnest(['lat', 'sst', 'chl']) as variable, unnest([t.lat, t.sst, t.chl]) as z from sent join ranked s using (rank) join ranked t on t.rank = sent.slot),
      o as {_fit_sql('long', '')}, p as {_fit_sql('perm', 'k, ')}
      select o.variable, round(any_value(o.r2), 6) as r2, count(*) filter (p.r2 >= o.r2 - 1e-12) as hits, round((count(*) filter (p.r2 >= o.r2 - 1e-12) + 1) / 1001.0, 6) as p_value
      from o join p using (variable) group by 1""",
    "factor_fit_test": f"""with recursive {_SCORES}, {_permuted_sql("scores")},
      perm as (select k, s.u, s.v, t.label from sent join ranked s using (rank) join ranked t on t.rank = sent.slot union all select 0, u, v, label from ranked),
      l as (select k, count(*) as n, sum(u) as su, sum(v) as sv, sum(u * u + v * v) as ss from perm group by k, label),
      f as (select k, (sum((su * su + sv * sv) / n) - (sum(su) * sum(su) + sum(sv) * sum(sv)) / sum(n)) / (sum(ss) - (sum(su) * sum(su) + sum(sv) * sum(sv)) / sum(n)) as r2 from l group by k)
      select round(o.r2, 6) as r2, count(*) as hits, round((count(*) + 1) / 1001.0, 6) as p_value from f join (select r2 from f where k = 0) o on f.r2 >= o.r2 - 1e-12 where k > 0 group by o.r2""",
}
