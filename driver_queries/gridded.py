"""Grid, mooring and region queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.fixed_values import WEEKLY_ORIGIN_DAY
from brinedeck.functions import timefn
from brinedeck.functions.missing import range_null
from brinedeck.operators import geo, gridmatch, mooring
from brinedeck.operators import grid as op
from brinedeck.operators.quality import in_bbox
from driver_queries import roles
from driver_queries.roles import GRID, GRID_AXIS, LAYERS, NORTH_FIRST, POINTS, r, table

XY = {"lon": "x", "lat": "y", "lon_axis": GRID_AXIS, "lat_axis": GRID_AXIS}


def match_grid_nearest(spark, d):
    out = gridmatch.match_grid(
        roles.points(spark, d), roles.layers(spark, d), **XY, products={"sst_1m": "sst", "chl_1m": "chl"}, period="period",
    )
    return out.select("pid", "period", r("sst_1m").alias("sst_1m"), r("chl_1m").alias("chl_1m"))


def match_grid_window_mean(spark, d):
    out = gridmatch.match_grid(
        roles.points(spark, d), roles.layers(spark, d), **XY, products={"sst_1m": "sst", "chl_1m": "chl"}, period="period", res_spat=4,
    )
    return out.select("pid", "period", r("sst_1m").alias("sst_1m"), r("chl_1m").alias("chl_1m"))


def match_irregular_axis(spark, d):
    axis = roles.grid(spark, d).select("lon_idx", (F.col("lon_idx") * F.col("lon_idx") / 7.0).alias("lon")).distinct()
    out = gridmatch.nearest_on_axis(roles.points(spark, d), axis, coord="x", axis_coord="lon", idx="lon_idx", bin_width=0.5)
    return out.select("pid", "lon_idx")


def _sea_level(spark, d):
    v = F.col("value")
    return roles.grid(spark, d).groupBy(
        F.col("label").alias("year"), (F.col("vec_id") % 50 * 7 + 1).cast("int").alias("slice_doy"), "lon_idx", "lat_idx",
    ).agg(F.avg(v).alias("GSLA"), F.max(v).alias("GSL"), F.min(v).alias("UCUR"), F.sum(v).alias("VCUR"))


def match_altimetry(spark, d):
    pts = roles.points(spark, d).withColumn("doy", (F.col("pid") % 366 + 1).cast("int")).withColumnRenamed("period", "year")
    out = gridmatch.match_altimetry(pts, _sea_level(spark, d), **XY, year="year", doy="doy", res_spat=2)
    return out.select("pid", *[r(c).alias(c) for c in ("GSLA", "GSL", "UCUR", "VCUR", "Longitude_Actual", "Latitude_Actual")])


def _sst(spark, d):
    return roles.layers(spark, d).filter("product = 'sst'")


def bilinear_match(spark, d):
    out = gridmatch.bilinear_match(roles.points(spark, d), _sst(spark, d), **XY, period="period", values={"sst": "value"})
    return out.select("pid", r("sst").alias("sst"))


def regrid_linear(spark, d):
    """Every layer's mean onto nodes shifted by part of a cell."""
    mean = roles.grid(spark, d).groupBy("lon_idx", "lat_idx").agg(F.avg("value").alias("value"))
    target = mean.select((F.col("lon_idx") + 0.5).alias("x"), (F.col("lat_idx") * 0.75).alias("y"))
    out = gridmatch.regrid_linear(mean, target, **XY)
    return out.select("x", "y", r("value").alias("value"))


def bracket_match(spark, d):
    """Latitudes run north to south here."""
    out = gridmatch.bracket_match(
        roles.points(spark, d), _sst(spark, d), lon="x", lat="y", lon_axis=GRID_AXIS, lat_axis=NORTH_FIRST, period="period",
    )
    return out.select("pid", r("value").alias("value"))


def window_first_match(spark, d):
    out = gridmatch.window_first_match(
        roles.points(spark, d), _sst(spark, d), lon="x", lat="y", lon_axis=GRID_AXIS, lat_axis=NORTH_FIRST, half=0.45, period="period",
    )
    return out.select("pid", r("value").alias("value"))


def match_climatology(spark, d):
    v = F.col("value")
    terms = roles.grid(spark, d).groupBy("lon_idx", "lat_idx").agg(
        F.avg(v).alias("mean"), F.min(v).alias("an_cos"), F.max(v).alias("an_sin"),
        F.avg(F.when(F.col("label") < 5, v)).alias("sa_cos"), F.avg(F.when(F.col("label") >= 5, v)).alias("sa_sin"),
    )
    pts = roles.points(spark, d).withColumn("doy", (F.col("pid") % 366 + 1).cast("int"))
    out = gridmatch.match_climatology(pts, terms, **XY, doy="doy")
    return out.select("pid", r("mean").alias("mean"), r("value").alias("value"))


def weekly_slice(spark, d):
    """Days of orders as slices; shipments take the first slice after their cycle."""
    orders = table(spark, d, "orders")
    day = F.round(timefn.days_since(F.col("o_orderdate"), "1800-01-01")).cast("bigint")
    slices = orders.select(day.alias("day")).distinct()
    mapping = gridmatch.weekly_slices(slices, "day", WEEKLY_ORIGIN_DAY)
    shipped = table(spark, d, "lineitem").select("l_orderkey", timefn.weekly_cycle(F.col("l_shipdate")).alias("cycle"))
    return shipped.join(mapping, "cycle", "left").groupBy("cycle", "day").agg(F.count(F.lit(1)).alias("n"))


def composite_match(spark, d):
    """Orders meet the 8-day and the monthly mean of shipments."""
    line = table(spark, d, "lineitem")
    when = F.col("l_shipdate")
    eight = line.groupBy(timefn.composite8_key(when).alias("eight")).agg(F.avg("l_quantity").alias("q8"))
    month = line.groupBy(timefn.month_key(when).alias("month")).agg(F.avg("l_quantity").alias("qm"))
    o = table(spark, d, "orders").select(
        "o_orderkey", timefn.composite8_key(F.col("o_orderdate")).alias("eight"), timefn.month_key(F.col("o_orderdate")).alias("month"),
    )
    return o.join(eight, "eight", "left").join(month, "month", "left").select("o_orderkey", r("q8").alias("q8"), r("qm").alias("qm"))


# ring corners relative to the region's origin: outer box with a hole, triangle, L shape
_SHAPES = {
    0: [[(0.033, 0.0071), (1.433, 0.0071), (1.433, 1.4071), (0.033, 1.4071)], [(0.433, 0.4071), (0.933, 0.4071), (0.933, 0.9071), (0.433, 0.9071)]],
    1: [[(0.033, 0.0071), (1.733, 0.3071), (0.633, 1.5071)]],
    2: [[(0.033, 0.0071), (1.433, 0.0071), (1.433, 0.5071), (0.533, 0.5071), (0.533, 1.4071), (0.033, 1.4071)]],
}
_CORNERS = [(shape, ring, seq, x, y) for shape, rings in _SHAPES.items() for ring, pts in enumerate(rings) for seq, (x, y) in enumerate(pts)]


def _vertices(spark, d):
    """A region per nation, on a 5 x 5 lattice."""
    corner = F.array(*[
        F.struct(F.lit(s).alias("shape"), F.lit(k).alias("ring"), F.lit(q).alias("seq"), F.lit(x).alias("dx"), F.lit(y).alias("dy")) for s, k, q, x, y in _CORNERS
    ])
    key = F.col("n_nationkey")
    return table(spark, d, "nation").select("n_name", key, F.inline(corner)).filter(F.col("shape") == key % 3).select(
        F.col("n_name").alias("region"), "ring", "seq",
        (F.col("dx") + key % 5 * 1.5).alias("x"), (F.col("dy") + F.floor(key / 5) * 1.5).alias("y"),
    )


def region_join(spark, d):
    edges = geo.polygon_edges(_vertices(spark, d), ["region"])
    return geo.region_join(roles.points(spark, d), edges, x="x", y="y", region=["region"], tile=0.5).select("pid", "region")


def region_bbox_fallback(spark, d):
    edges = geo.polygon_edges(_vertices(spark, d), ["region"])
    tagged = geo.region_join(roles.points(spark, d), edges, x="x", y="y", region=["region"], tile=0.5)
    boxes = geo.region_boxes(edges, "region", ["NATION_7", "NATION_1", "NATION_12", "NATION_24"])
    return geo.region_bbox_fallback(tagged, x="x", y="y", region="region", boxes=boxes).select("pid", "region")


def region_on_edge(spark, d):
    """Points on the edges and corners of the customers' nations, holes too, and a millionth above them."""
    vertices = _vertices(spark, d).withColumns({"x": r("x"), "y": r("y")})
    edges = geo.polygon_edges(vertices, ["region"])
    along = F.col("c_custkey") % 5 / 4.0
    above = F.when(F.col("c_custkey") % 3 == 0, 0.000001).otherwise(0.0)
    points = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        edges.withColumnRenamed("region", "n_name"), "n_name",
    ).select(F.col("c_custkey").alias("pid"), r(F.col("x1") + along * (F.col("x2") - F.col("x1"))).alias("x"), r(F.col("y1") + along * (F.col("y2") - F.col("y1")) + above).alias("y"))
    return geo.region_join(points, edges, x="x", y="y", region=["region"], tile=0.5)


def region_attributes(spark, d):
    edges = geo.polygon_edges(_vertices(spark, d), ["region"])
    return edges.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_edges"), r(F.min("x1")).alias("minx"), r(F.max("x1")).alias("maxx"), r(F.min("y1")).alias("miny"), r(F.max("y1")).alias("maxy"),
    )


def _moored(spark, d):
    return roles.events(spark, d).select(
        F.col("user_id").alias("site"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
        (F.floor(F.col("value") * 100) % 12000 / 100.0).alias("depth"), F.col("value").alias("temp"),
    )


def depth_bin_series(spark, d):
    out = op.depth_bin_series(_moored(spark, d), site="site", time="time", depth="depth", value="temp")
    return out.select("site", "DepthBin", "time", r("temp").alias("temp"))


def doy_climatology(spark, d):
    out = op.doy_climatology(_moored(spark, d), site="site", time="time", depth="depth", value="temp")
    return out.select("site", "DepthBin", F.col("DOY").cast("bigint").alias("DOY"), r("temp").alias("temp"))


def _nominal(spark, d):
    return roles.events(spark, d).select(
        F.col("user_id").alias("site_code"), F.concat(F.lit("org/net/"), F.col("event_type"), F.lit("/gridded_timeseries/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_id") % 3 == 0, "TRUE").otherwise("FALSE").alias("realtime"),
        F.col("ts").alias("time"), (F.floor(F.col("value") / 10) * 10 % 100).cast("int").alias("depth"), F.col("value").alias("temp"),
        (-F.col("user_id") / 8.0).alias("lat"), (F.col("value") / 4.0).alias("lon"),
    )


def mooring_catalog(spark, d):
    return mooring.mooring_catalog(_nominal(spark, d)).groupBy("site_code").agg(F.count_distinct("url").alias("n_files"))


def mooring_summary(spark, d):
    out = mooring.mooring_summary(_nominal(spark, d), site="site_code", source="url", lat="lat", lon="lon", time="time", depth="depth")
    return out.select("url", "site_code", "facility", r("latitude").alias("latitude"), r("longitude").alias("longitude"), "time_start", "time_end", "depths")


def mooring_series(spark, d):
    return mooring.mooring_series(
        _nominal(spark, d), site="site_code", site_value=8, depth="depth", depth_value=20, time="time", value="temp", start="2024-01-03", end="2024-01-25",
    )


def melt_grid(spark, d):
    return roles.grid(spark, d).groupBy("lat_idx", "lon_idx").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


def melt_columns(spark, d):
    line = table(spark, d, "lineitem").select("l_suppkey", "l_quantity", F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("l_tax"), "l_discount")
    long = op.melt_columns(line, ["l_suppkey"], ["l_quantity", "l_tax", "l_discount"], "measure", "value")
    return long.groupBy("l_suppkey", "measure").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


def grid_bbox(spark, d):
    rows = in_bbox(roles.grid(spark, d), "lon", "lat", (1.0, 3.0, 2.0, 4.0))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), r(F.min("value")).alias("low"))


def box_series(spark, d):
    out = op.box_series(roles.grid(spark, d), bounds=(1.0, 3.0, 2.0, 4.0), time="vec_id")
    return out.select("vec_id", r("value").alias("value"))


def block_mean(spark, d):
    rows = roles.grid(spark, d).withColumn("value", F.when(F.col("value") > -0.1, F.col("value")))
    return op.block_mean(rows, by=["vec_id"], k=4).select("vec_id", "lon_blk", "lat_blk", r("value").alias("value"))


def cell_trend(spark, d):
    rows = roles.grid(spark, d).withColumn("value", range_null(F.col("value"), -0.15, 0.4))
    return op.cell_trend(rows, cell=["lon_idx", "lat_idx"], time="vec_id").select("lon_idx", "lat_idx", r("slope", 9).alias("slope"))


def regrid_bins(spark, d):
    ev = roles.events(spark, d).select(timefn.decimal_year(F.col("ts")).alias("t"), (F.col("value") % 100).alias("depth"), F.floor("value").cast("double").alias("value"))
    return op.regrid_bins(ev, x="t", y="depth", value="value", nx=20, ny=25, y_range=(0.0, 100.0)).select(
        "x_bin", "y_bin", "value")


def monthly_spine(spark, d):
    """Months without an order of a customer are kept as 0."""
    o = table(spark, d, "orders")
    spine = op.monthly_spine(o, by=["o_custkey"], time="o_orderdate")
    n = o.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(n, ["o_custkey", "month"], "left").select("o_custkey", F.col("month").cast("string").alias("month"), F.coalesce("n", F.lit(0)).alias("n"))


QUERIES = {f.__name__: f for f in (
    match_grid_nearest, match_grid_window_mean, match_irregular_axis, match_altimetry, bilinear_match, regrid_linear, bracket_match,
    window_first_match, match_climatology, weekly_slice, composite_match, region_join, region_bbox_fallback, region_on_edge, region_attributes,
    depth_bin_series, doy_climatology, mooring_catalog, mooring_summary, mooring_series, melt_grid, melt_columns, grid_bbox, box_series,
    block_mean, cell_trend, regrid_bins, monthly_spine,
)}

_NEAR = "cast(greatest(least(ceil({c} - 0.5), 7), 0) as integer)"
_CELL = f"cells as (select *, {_NEAR.format(c='x')} as ix, {_NEAR.format(c='y')} as iy from {POINTS})"


def _window_sql(lo: int, hi: int) -> str:
    def avg(product: str) -> str:
        return f"round(avg(value) filter (product = '{product}'), 6)"
    return f"""with {_CELL}, layers as {LAYERS}
      select pid, c.period, {avg('sst')} as sst_1m, {avg('chl')} as chl_1m from cells c
      left join layers g on g.period = c.period and g.lon_idx between c.ix + ({lo}) and c.ix + ({hi}) and g.lat_idx between c.iy + ({lo}) and c.iy + ({hi})
      group by pid, c.period"""


_V = "({i}, {j})"
_BILINEAR = """select {ids}, case when count(g.value) = 4 then sum(g.value * (case c.cx when 1 then 1 - wx else wx end) * (case c.cy when 1 then 1 - wy else wy end)) end as v
  from box cross join (select unnest([1, 1, 2, 2]) as cx, unnest([1, 2, 1, 2]) as cy) c
  left join {grid} g on {on} g.lon_idx = case c.cx when 1 then x1 else x2 end and g.lat_idx = case c.cy when 1 then y1 else y2 end group by {ids}"""
_CORNER_ROWS = ", ".join(f"({s}, {k}, {q}, {x}, {y})" for s, k, q, x, y in _CORNERS)
_EDGES = f"""verts as (select n_name as region, ring, seq, cast(dx + n_nationkey % 5 * 1.5 as double) as x, cast(dy + n_nationkey // 5 * 1.5 as double) as y
    from nation join (values {_CORNER_ROWS}) t(shape, ring, seq, dx, dy) on shape = n_nationkey % 3),
  edges as (select region, x as x1, y as y1, coalesce(lead(x) over w, first(x) over w) as x2, coalesce(lead(y) over w, first(y) over w) as y2
    from verts window w as (partition by region, ring order by seq)),
  hits as (select pid, region from {POINTS} p join edges e on (y1 > p.y) <> (y2 > p.y) and p.x < x1 + (p.y - y1) * (x2 - x1) / nullif(y2 - y1, 0)
    group by pid, region having count(*) % 2 = 1),
  tagged as (select p.*, (select min(region) from hits h where h.pid = p.pid) as region from {POINTS} p)"""
_MOORED = """(select user_id as site, date_trunc('hour', ts)::timestamp as time, cast(floor(value * 100) as bigint) % 12000 / 100.0 as depth, value as temp from events)"""
_BIN = """case when depth > 0 and depth <= 20 then '0 - 20m' when depth > 20 and depth <= 40 then '20 - 40m' when depth > 40 and depth <= 60 then '40 - 60m'
  when depth > 60 and depth <= 80 then '60 - 80m' when depth > 80 and depth <= 100 then '80 - 100m' end"""
_NOMINAL = """(select user_id as site_code, 'org/net/' || event_type || '/gridded_timeseries/' || user_id as url, event_type as facility,
  case when event_id % 3 = 0 then 'TRUE' else 'FALSE' end as realtime, ts as time, cast(floor(value / 10) as bigint) * 10 % 100 as depth, value as temp,
  -user_id / 8.0 as lat, value / 4.0 as lon from events)"""
_K8 = """strftime({t}, '%Y') || printf('%03d', (dayofyear({t}) - 1) // 8 * 8 + 1) || strftime({t}, '%Y')
  || printf('%03d', least((dayofyear({t}) - 1) // 8 * 8 + 8, case when year({t}) % 4 = 0 then 366 else 365 end))"""
_CYCLE = "cast(round_even((round_even((epoch_us({t}) - epoch_us(timestamp '1800-01-01')) / 8.64e10, 0) - 66410) / 7.0, 0) as bigint)"
_T = "(2 * pi() * (pid % 366 + 1) / 366)"
_DEC = "(year(ts) + (epoch_us(ts) - epoch_us(date_trunc('year', ts)::timestamp)) / (366 * 8.64e10))"

SQL = {
    "match_grid_nearest": _window_sql(0, 0),
    "match_grid_window_mean": _window_sql(-2, 1),
    "match_irregular_axis": f"""with a as (select i as lon_idx, i * i / 7.0 as lon from range(0, 8) t(i))
      select pid, cast(arg_min(lon_idx, abs(x - lon) + lon_idx * 1e-12) as integer) as lon_idx from {POINTS} cross join a group by pid""",
    "match_altimetry": f"""with {_CELL}, g as (select label as year, cast(vec_id % 50 * 7 + 1 as integer) as sdoy, lon_idx, lat_idx, avg(value) as a, max(value) as b, min(value) as c, sum(value) as d from {GRID} group by all),
      s as (select distinct year, sdoy from g),
      p as (select cells.*, pid % 366 + 1 as doy from cells),
      q as (select p.*, s.sdoy from p left join s on s.year = p.period qualify row_number() over (partition by pid order by abs(doy - sdoy), sdoy) = 1)
      select pid, round(avg(a), 6) as "GSLA", round(avg(b), 6) as "GSL", round(avg(c), 6) as "UCUR", round(avg(d), 6) as "VCUR",
        cast(any_value(ix) - 1 as double) as "Longitude_Actual", cast(any_value(iy) - 1 as double) as "Latitude_Actual"
      from q left join g on g.year = q.period and g.sdoy = q.sdoy and g.lon_idx between ix - 1 and ix and g.lat_idx between iy - 1 and iy group by pid""",
    "bilinear_match": f"""with box as (select *, floor(x) as x1, ceil(x) as x2, floor(y) as y1, ceil(y) as y2, x - floor(x) as wx, y - floor(y) as wy from {POINTS}),
      g as (select * from {LAYERS} where product = 'sst'), b as ({_BILINEAR.format(ids='pid', grid='g', on='g.period = box.period and')})
      select pid, round(v, 6) as sst from b""",
    "regrid_linear": f"""with g as (select lon_idx, lat_idx, avg(value) as value from {GRID} group by all),
      t as (select cast(lon_idx + 0.5 as double) as x, cast(lat_idx * 0.75 as double) as y from g),
      box as (select *, floor(x) as x1, ceil(x) as x2, floor(y) as y1, ceil(y) as y2, x - floor(x) as wx, y - floor(y) as wy from t),
      b as ({_BILINEAR.format(ids='x, y', grid='g', on='')}) select x, y, round(v, 6) as value from b""",
    "bracket_match": f"""with g as (select * from {LAYERS} where product = 'sst')
      select pid, round(value, 6) as value from {POINTS} p left join g on g.period = p.period and g.lon_idx = floor(x) and g.lat_idx = 7 - ceil(y)""",
    "window_first_match": f"""with g as (select * from {LAYERS} where product = 'sst'),
      a as (select i as ix from range(0, 8) t(i))
      select pid, round(value, 6) as value from {POINTS} p
      left join g on g.period = p.period and g.lon_idx = (select min(ix) from a where round(abs(ix - x), 9) < 0.45)
        and g.lat_idx = (select min(ix) from a where round(abs(7 - ix - y), 9) < 0.45)""",
    "match_climatology": f"""with g as (select lon_idx, lat_idx, avg(value) as m, min(value) as ac, max(value) as asn, avg(value) filter (label < 5) as sc, avg(value) filter (label >= 5) as ss from {GRID} group by all)
      select pid, round(m, 6) as mean, round(m + ac * cos{_T} + asn * sin{_T} + sc * cos(2 * {_T}) + ss * sin(2 * {_T}), 6) as value
      from {POINTS} left join g on lon_idx = round_even(x, 0) and lat_idx = round_even(y, 0)""",
    "weekly_slice": f"""with s as (select distinct cast(date_diff('day', date '1800-01-01', cast(o_orderdate as date)) as bigint) as day from orders),
      l as (select {_CYCLE.format(t='l_shipdate')} as cycle, count(*) as n from lineitem group by 1),
      lo as (select min(day) as d0 from s)
      select cycle, (select min(day) from s where day > cycle * 7 + 66410 and cycle * 7 + 66410 >= (select d0 from lo) - 7) as day, n from l""",
    "composite_match": f"""with a as (select {_K8.format(t='l_shipdate')} as k, avg(l_quantity) as q from lineitem group by 1),
      b as (select date_trunc('month', l_shipdate) as k, avg(l_quantity) as q from lineitem group by 1)
      select o_orderkey, round(a.q, 6) as q8, round(b.q, 6) as qm from orders left join a on a.k = {_K8.format(t='o_orderdate')} left join b on b.k = date_trunc('month', o_orderdate)""",
    "region_join": f"with {_EDGES} select pid, region from tagged",
    "region_bbox_fallback": f"""with {_EDGES}, bx as (select region, min(x) as a, max(x) as b, min(y) as c, max(y) as e from verts group by region),
      o as (select *, case region when 'NATION_7' then 1 when 'NATION_1' then 2 when 'NATION_12' then 3 else 4 end as ord from bx where region in ('NATION_7', 'NATION_1', 'NATION_12', 'NATION_24'))
      select pid, coalesce(t.region, (select arg_min(o.region, ord) from o where t.x between a and b and t.y between c and e)) as region from tagged t""",
    "region_on_edge": f"""with verts as (select n_name as region, n_nationkey, ring, seq, cast(dx + n_nationkey % 5 * 1.5 as decimal(12,6)) as x, cast(dy + n_nationkey // 5 * 1.5 as decimal(12,6)) as y
        from nation join (values {_CORNER_ROWS}) t(shape, ring, seq, dx, dy) on shape = n_nationkey % 3),
      edges as (select region, n_nationkey, x as x1, y as y1, coalesce(lead(x) over w, first(x) over w) as x2, coalesce(lead(y) over w, first(y) over w) as y2
        from verts window w as (partition by region, ring order by seq)),
      pts as (select row_number() over (order by c_custkey, x1, y1, x2, y2) as n, c_custkey as pid, cast(x1 + cast(c_custkey % 5 * 0.25 as decimal(4,2)) * (x2 - x1) as decimal(12,6)) as x,
        cast(y1 + cast(c_custkey % 5 * 0.25 as decimal(4,2)) * (y2 - y1) + case when c_custkey % 3 = 0 then 0.000001 else 0 end as decimal(12,6)) as y
        from customer join edges on c_nationkey = n_nationkey),
      near as (select n, region, (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) as side, x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2) as boxed,
        (y1 > y) <> (y2 > y) as spans, y2 > y1 as up from pts, edges where y between least(y1, y2) and greatest(y1, y2)),
      hits as (select n, region from near group by n, region having bool_or(side = 0 and boxed) or count(*) filter (spans and (side > 0) = up and side <> 0) % 2 = 1),
      firsts as (select n, min(region) as region from hits group by n)
      select pid, cast(x as double) as x, cast(y as double) as y, region from pts left join firsts using (n)""",
    "region_attributes": f"with {_EDGES} select region, count(*) as n_edges, round(min(x1), 6) as minx, round(max(x1), 6) as maxx, round(min(y1), 6) as miny, round(max(y1), 6) as maxy from edges group by 1",
    "depth_bin_series": f"""select site, {_BIN} as "DepthBin", time, round(avg(temp), 6) as temp from {_MOORED} where {_BIN} is not null group by 1, 2, 3""",
    "doy_climatology": f"""select site, {_BIN} as "DepthBin", dayofyear(time) as "DOY", round(avg(temp), 6) as temp from {_MOORED} where {_BIN} is not null group by 1, 2, 3""",
    "mooring_catalog": f"select site_code, count(distinct url) as n_files from {_NOMINAL} where realtime = 'FALSE' group by 1",
    "mooring_summary": f"""select url, site_code, any_value(facility) as facility, round((min(lat) + max(lat)) / 2, 6) as latitude, round((min(lon) + max(lon)) / 2, 6) as longitude,
      min(time) as time_start, max(time) as time_end, array_to_string(list_sort(list(distinct depth)), ', ') as depths from {_NOMINAL} group by url, site_code""",
    "mooring_series": f"select time, temp from {_NOMINAL} where site_code = 8 and depth = 20 and time between timestamp '2024-01-03' and timestamp '2024-01-25'",
    "melt_grid": f"select lat_idx, lon_idx, count(*) as n, round(sum(value), 4) as total from {GRID} group by 1, 2",
    "melt_columns": """select l_suppkey, measure, count(*) as n, round(sum(value), 4) as total from (
        select l_suppkey, 'l_quantity' as measure, l_quantity as value from lineitem union all select l_suppkey, 'l_discount', l_discount from lineitem
        union all select l_suppkey, 'l_tax', l_tax from lineitem where l_tax > 0.02) group by 1, 2""",
    "grid_bbox": f"select label, count(*) as n, round(min(value), 6) as low from {GRID} where lon between 1 and 3 and lat between 2 and 4 group by 1",
    "box_series": f"select vec_id, round(avg(value), 6) as value from {GRID} where lon between 1 and 3 and lat between 2 and 4 group by 1",
    "block_mean": f"select vec_id, lon_idx // 4 as lon_blk, lat_idx // 4 as lat_blk, round(avg(value), 6) as value from {GRID} where value > -0.1 group by 1, 2, 3",
    "cell_trend": f"""with g as (select *, case when value > -0.15 and value < 0.4 then value end as v from {GRID})
      select lon_idx, lat_idx, case when max(v) filter (vec_id = (select min(vec_id) from g)) is not null then round(regr_slope(v, vec_id), 9) end as slope from g group by 1, 2""",
    "regrid_bins": f"""with e as (select {_DEC} as t, value % 100 as depth, value from events), b as (select min(t) as t0, max(t) as t1 from e)
      select cast(least(floor((t - t0) * 20 / (t1 - t0)), 19) as integer) as x_bin, cast(least(floor(depth * 25 / 100.0), 24) as integer) as y_bin, avg(floor(value)) as value
      from e, b group by 1, 2""",
    "monthly_spine": """with s as (select o_custkey, cast(unnest(generate_series(date_trunc('month', min(o_orderdate))::timestamp, date_trunc('month', max(o_orderdate))::timestamp, interval 1 month)) as date) as month from orders group by 1)
      select s.o_custkey, cast(s.month as varchar) as month, count(o_orderkey) as n from s left join orders o on o.o_custkey = s.o_custkey and date_trunc('month', o_orderdate) = s.month group by 1, 2""",
}
