"""Readers and stored grids on files written from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brinedeck.functions.timefn import decimal_year
from brinedeck.operators import gridmatch
from brinedeck.operators import grid as op
from brinedeck.operators.surface import fitted_surface
from brinedeck.plans import series
from brinedeck.session import shared_folder
from brinedeck.sources.readers import read_obs_csv
from driver_queries import roles
from driver_queries.gridded import _BILINEAR, _DEC, _MOORED, _window_sql
from driver_queries.roles import GRID_AXIS, LAYERS, NORTH_FIRST, POINTS, r, table

XY = {"lon": "x", "lat": "y", "lon_axis": GRID_AXIS, "lat_axis": GRID_AXIS}
ORDER = {"trip": ("O_ORDERKEY", "bigint"), "price": ("o_totalprice", "double"), "clerk": ("o_comment_like", "string"), "priority": ("O_orderPriority", "string")}


def csv_header_order(spark, d):
    """One folder whose files order their columns in two ways and lack different ones; a text column has commas and quotes."""
    o = table(spark, d, "orders").withColumn("o_comment_like", F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('", '), F.col("o_orderkey").cast("string")))
    path = f"{shared_folder(spark)}/header_order_{uuid.uuid4().hex}"
    even = F.col("o_orderkey") % 2 == 0
    write = lambda rows: rows.write.mode("append").option("header", True).option("escape", '"').csv(path)
    write(o.filter(even).select("o_orderkey", "o_totalprice", "o_comment_like"))
    write(o.filter(~even).select("o_comment_like", "o_orderpriority", "o_totalprice", "o_orderkey"))
    return read_obs_csv(spark, path, ORDER)


def preamble_csv(spark, d):
    """A file per month with lines before its header; some data lines look like them."""
    o = table(spark, d, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    head = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(text).alias("value")) for i, text in enumerate(("about: this file", "1,2", "o_orderkey,o_custkey"))])
    lines = o.select(month.alias("month"), F.lit(9).cast("int").alias("at"), line.alias("value")).unionByName(
        o.select(month.alias("month")).distinct().select("month", F.inline(head)).unionByName(o.select(month.alias("month")).distinct().select("month", F.lit(10).alias("at"), F.lit("1,2").alias("value")))
    )
    path = f"{shared_folder(spark)}/preamble_{uuid.uuid4().hex}"
    lines.repartition("month").sortWithinPartitions("month", "at").select("month", "value").write.partitionBy("month").text(path)
    return read_obs_csv(spark, path, {"trip": ("o_orderkey", "bigint"), "customer": ("O_CUSTKEY", "bigint")}, preamble=2)


def _stored(spark, d):
    path = f"{shared_folder(spark)}/layers_{uuid.uuid4().hex}"
    roles.layers(spark, d).write.partitionBy("period").parquet(path)
    return spark.read.parquet(path)


def stored_grid_window(spark, d):
    """Match-up with layers stored by period: only the points' periods are opened."""
    out = gridmatch.match_grid(roles.points(spark, d), _stored(spark, d), **XY, products={"sst_1m": "sst", "chl_1m": "chl"}, period="period", res_spat=4)
    return out.select("pid", "period", r("sst_1m").alias("sst_1m"), r("chl_1m").alias("chl_1m"))


def stored_grid_bilinear(spark, d):
    grid = _stored(spark, d).filter("product = 'sst'")
    return gridmatch.bilinear_match(roles.points(spark, d), grid, **XY, period="period", values={"sst": "value"}).select("pid", r("sst").alias("sst"))


def stored_grid_bracket(spark, d):
    grid = _stored(spark, d).filter("product = 'chl'")
    out = gridmatch.bracket_match(roles.points(spark, d), grid, lon="x", lat="y", lon_axis=GRID_AXIS, lat_axis=NORTH_FIRST, period="period")
    return out.select("pid", r("value").alias("value"))


def contour_by_type(spark, d):
    """Bin means of every event type over its own range of time and depth."""
    e = roles.events(spark, d).select("event_type", decimal_year(F.col("ts")).alias("t"), (F.col("value") % 100).alias("depth"), F.floor("value").alias("value"))
    out = op.regrid_bins(e, x="t", y="depth", value="value", nx=20, ny=25, by=["event_type"])
    return out.select("event_type", "x_bin", "y_bin", r("value").alias("value"))


def contour_surface(spark, d):
    """The surface fitted to every event type over its own range of time and depth."""
    e = roles.events(spark, d).select("event_type", decimal_year(F.col("ts")).alias("t"), (F.col("value") % 100).alias("depth"), F.floor("value").alias("value"))
    out = fitted_surface(e, x="t", y="depth", value="value", by=["event_type"], nx=20, ny=25, cells=(1, 5), levels=5)
    return out.select("event_type", "x_idx", "y_idx", r("value").alias("value"))


def mooring_contour(spark, d):
    """The contour of the mooring products, for every site."""
    v = F.floor(F.col("value") * 100).cast("long")
    moored = roles.events(spark, d).select(F.col("user_id").alias("site"), F.date_trunc("hour", "ts").alias("time"), (v % 12000 / 100.0).alias("depth"), F.col("value").alias("temp"))
    out = series.mooring_products(moored, nx=6, ny=8, levels=3)["contour"]
    return out.select("site", "x_idx", "y_idx", r("depth").alias("depth"), r("temp", 5).alias("temp"))


QUERIES = {f.__name__: f for f in (csv_header_order, preamble_csv, stored_grid_window, stored_grid_bilinear, stored_grid_bracket, contour_by_type, contour_surface, mooring_contour)}


def _basis_sql(k: str, t: str) -> str:
    return f"(case {k} when 0 then (1 - {t}) * (1 - {t}) * (1 - {t}) when 1 then 3 * {t} * {t} * {t} - 6 * {t} * {t} + 4 when 2 then -3 * {t} * {t} * {t} + 3 * {t} * {t} + 3 * {t} + 1 else {t} * {t} * {t} end / 6)"


def _surface_sql(rows: str, by: str, nx: int, ny: int, cells: tuple[int, int], levels: int, out: str) -> str:
    """Sum of levels, each fitted to what the levels before leave; ``rows`` has ``by``, x, y and z."""
    parts = [
        f"raw as ({rows})", f"ends as (select {by}, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from raw group by 1)",
        f"""p0 as (select row_number() over () as id, {by}, coalesce((x - x0) / nullif(x1 - x0, 0), 0) as u, coalesce((y - y0) / nullif(y1 - y0, 0), 0) as v, cast(z as double) as z
          from raw join ends using ({by}))""",
        f"g as (select ends.*, x_idx, y_idx, x_idx / {nx - 1} as u, y_idx / {ny - 1} as v from ends, range({nx}) a(x_idx), range({ny}) b(y_idx))",
    ]

    def spread(table: str, n: int, m: int) -> str:
        placed = f"select *, cast(least(floor(u * {n}), {n - 1}) as integer) as i, cast(least(floor(v * {m}), {m - 1}) as integer) as j from {table}"
        return f"""(select *, i + k as a, j + l as b, {_basis_sql("k", f"(u * {n} - i)")} * {_basis_sql("l", f"(v * {m} - j)")} as w from ({placed}), range(4) x(k), range(4) y(l))"""

    for level in range(levels):
        n, m = cells[0] << level, cells[1] << level
        parts += [
            f"e{level} as materialized (select *, sum(w * w) over (partition by id) as q from {spread(f'p{level}', n, m)})",
            f"n{level} as materialized (select {by}, a, b, coalesce(sum(w * w * w * z / q) / nullif(sum(w * w), 0), 0) as phi from e{level} group by all)",
            f"f{level} as (select {by}, x_idx, y_idx, sum(w * phi) as f from {spread('g', n, m)} join n{level} using ({by}, a, b) group by all)",
            f"p{level + 1} as materialized (select id, {by}, u, v, any_value(z) - sum(w * phi) as z from e{level} join n{level} using ({by}, a, b) group by id, {by}, u, v)",
        ]
    every = " union all ".join(f"select * from f{level}" for level in range(levels))
    return f"with {', '.join(parts)}, s as (select {by}, x_idx, y_idx, sum(f) as f from ({every}) group by all) {out}"


SQL = {
    "contour_surface": _surface_sql(
        f"select event_type, {_DEC} as x, value % 100 as y, floor(value) as z from events", "event_type", 20, 25, (1, 5), 5,
        "select event_type, cast(x_idx as integer) as x_idx, cast(y_idx as integer) as y_idx, round(coalesce(f, 0), 6) as value from g left join s using (event_type, x_idx, y_idx)",
    ),
    "mooring_contour": _surface_sql(
        f"select site, {_DEC.replace('ts', 'time')} as x, depth as y, temp as z from {_MOORED}", "site", 6, 8, (1, 5), 3,
        "select site, cast(x_idx as integer) as x_idx, cast(y_idx as integer) as y_idx, round(y0 + (y1 - y0) * v, 6) as depth, round(coalesce(f, 0), 5) as temp from g left join s using (site, x_idx, y_idx)",
    ),
    "csv_header_order": """select o_orderkey as trip, o_totalprice as price, 'say "' || o_orderstatus || '", ' || o_orderkey as clerk,
        case when o_orderkey % 2 = 1 then o_orderpriority end as priority from orders""",
    "preamble_csv": """select o_orderkey as trip, o_custkey as customer from orders
      union all select 1, 2 from (select distinct strftime(o_orderdate, '%Y%m') from orders)""",
    "stored_grid_window": _window_sql(-2, 1),
    "stored_grid_bilinear": f"""with box as (select *, floor(x) as x1, ceil(x) as x2, floor(y) as y1, ceil(y) as y2, x - floor(x) as wx, y - floor(y) as wy from {POINTS}),
      g as (select * from {LAYERS} where product = 'sst'), b as ({_BILINEAR.format(ids='pid', grid='g', on='g.period = box.period and')})
      select pid, round(v, 6) as sst from b""",
    "stored_grid_bracket": f"""with g as (select * from {LAYERS} where product = 'chl')
      select pid, round(value, 6) as value from {POINTS} p left join g on g.period = p.period and g.lon_idx = floor(x) and g.lat_idx = 7 - ceil(y)""",
    "contour_by_type": f"""with e as (select event_type, {_DEC} as t, value % 100 as depth, floor(value) as v from events),
      b as (select event_type, min(t) as t0, max(t) as t1, min(depth) as d0, max(depth) as d1 from e group by 1)
      select event_type, cast(least(floor((t - t0) * 20 / (t1 - t0)), 19) as integer) as x_bin, cast(least(floor((depth - d0) * 25 / (d1 - d0)), 24) as integer) as y_bin, round(avg(v), 6) as value
      from e join b using (event_type) group by all""",
}
