"""Quality-control, scalar and key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.functions import missing, ocean, text, timefn
from brinedeck.operators import quality as op
from brinedeck.operators.geo import lookup_tz
from brinedeck.operators.shuffle import left_join_nullsafe
from brinedeck.operators.summary import describe_measures
from driver_queries import roles
from driver_queries.roles import r, table


def qc_mask_replicate_mean(spark, d):
    line = table(spark, d, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linenumber", "l_quantity", F.floor("l_extendedprice").cast("double").alias("l_extendedprice"), "l_discount",
    )
    masked = op.qc_mask(line, {"l_quantity": "l_linenumber", "l_discount": "l_linenumber"})
    out = op.replicate_mean(masked, ["l_orderkey", "l_returnflag"], ["l_quantity", "l_extendedprice"], ["l_discount"])
    return out.select(
        "l_orderkey", "l_returnflag", r("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), r("l_discount").alias("discount"),
    )


def qc_keep_mean(spark, d):
    line = table(spark, d, "lineitem").withColumn("flag", F.col("l_linenumber") - 1)
    return op.mean_by_key(op.qc_keep(line, "flag"), ["l_suppkey"], {"quantity": "l_quantity"}).select("l_suppkey", r("quantity").alias("quantity"))


def duplicate_report(spark, d):
    return op.duplicate_report(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_max(spark, d):
    return op.duplicate_max(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def sample_universe(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").cast("string").alias("depth"))
    whole = table(spark, d, "orders").select(F.col("o_orderkey").alias("trip"), F.lit("WC").alias("depth"))
    return op.sample_universe(["trip", "depth"], lines, whole)


def ctd_by_depth(spark, d):
    line = table(spark, d, "lineitem").withColumn("depth", F.col("l_extendedprice") / 1000.0)
    out = op.ctd_by_depth(line, "l_suppkey", "depth", {"t": "l_quantity", "s": "l_discount", "chl": "l_tax"}, out_depth="depth_m")
    return out.select("l_suppkey", "depth_m", *[r(c).alias(c) for c in ("t", "s", "chl")])


def ctd_surface(spark, d):
    line = table(spark, d, "lineitem").withColumn("depth", F.col("l_extendedprice") / 1000.0)
    out = op.ctd_surface(line, "l_suppkey", "depth", {"t": "l_quantity", "s": "l_discount", "chl": "l_tax"})
    return out.select("l_suppkey", *[r(c).alias(c) for c in ("t", "s", "chl")])


def nutrient_mean(spark, d):
    out = op.mean_by_key(table(spark, d, "lineitem"), ["l_orderkey"], {"quantity": "l_quantity", "tax": "l_tax"})
    return out.select("l_orderkey", r("quantity").alias("quantity"), r("tax").alias("tax"))


def surface_pigment(spark, d):
    out = op.mean_by_key(table(spark, d, "lineitem"), ["l_orderkey"], {"chl": "l_tax"}, F.col("l_quantity") <= 25)
    return out.select("l_orderkey", r("chl").alias("chl"))


def nullsafe_water_quality_join(spark, d):
    """Samples with a missing depth meet measurements with a missing depth."""
    line = table(spark, d, "lineitem")
    depth = F.when(F.col("l_linenumber") < 7, F.col("l_linenumber"))
    keyed = line.select(F.col("l_suppkey").alias("trip"), depth.alias("depth"), "l_quantity")
    universe = op.sample_universe(["trip", "depth"], keyed)
    means = op.replicate_mean(keyed, ["trip", "depth"], ["l_quantity"])
    return left_join_nullsafe(universe, means, ["trip", "depth"]).select("trip", "depth", r("l_quantity").alias("quantity"))


def range_null(spark, d):
    line = table(spark, d, "lineitem")
    kept = missing.range_null(F.col("l_quantity"), 2.0, 40.0)
    return line.groupBy("l_suppkey").agg(F.count(kept).alias("n"), F.sum(kept).alias("total"))


def map_code(spark, d):
    flag = missing.map_code(F.col("l_returnflag"), {"A": "accepted", "R": "returned"}, "neither")
    return table(spark, d, "lineitem").groupBy(flag.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def column_fallback(spark, d):
    line = table(spark, d, "lineitem")
    measure = missing.nan_to_null(F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).when(F.col("l_linenumber") < 5, F.col("l_tax")))
    return line.groupBy("l_linenumber").agg(r(F.sum(F.coalesce(measure, F.col("l_discount"))), 4).alias("total"), F.count(measure).alias("n_measured"))


def sample_code(spark, d):
    orders = table(spark, d, "orders")
    depth = F.when(F.col("o_orderkey") % 5 == 0, "WC").otherwise((F.col("o_custkey") % 1200).cast("string"))
    return orders.select("o_orderkey", text.sample_code(F.col("o_orderkey"), depth, "N").alias("code"))


def paste_null(spark, d):
    obs = roles.taxa(spark, d)
    return obs.groupBy(text.genus_species(F.col("genus"), F.col("species")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def station_codes(spark, d):
    orders = table(spark, d, "orders")
    code = text.cast_code(F.concat(F.lit("NRS"), F.upper(F.substring("o_orderpriority", 3, 3))), F.col("o_orderdate"), ("NRSLOW",))
    part3 = text.path_part(F.concat(F.lit("a/b/"), F.col("o_orderpriority")), 3)
    return orders.select(
        "o_orderkey", code.alias("code"), text.station_of_cast(code).alias("station"), text.station_of_trip(code).alias("prefix"),
        text.first_word(F.col("o_orderpriority")).alias("word"), part3.alias("part3"), text.time_of_day(F.col("o_orderdate")).alias("time"),
    )


def identified_species_filter(spark, d):
    obs = roles.taxa(spark, d).filter(text.is_identified_species(F.col("species"), allow_slash=False, allow_empty=False))
    return obs.groupBy("species").agg(F.count(F.lit(1)).alias("n"))


def complete_cases(spark, d):
    return op.drop_incomplete(roles.taxa(spark, d)).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))


def bbox_filter(spark, d):
    pts = op.in_bbox(roles.points(spark, d), "x", "y", (1.0, 6.0, 0.5, 4.0))
    return pts.select("pid", r("x").alias("x"), r("y").alias("y"))


def distinct_by_key(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice")
    order = [F.col("l_shipdate"), F.col("l_quantity"), F.col("l_extendedprice")]
    return op.one_per_key(line, ["l_orderkey"], order)


def date_parts(spark, d):
    dated = op.require_date(table(spark, d, "orders").withColumnRenamed("o_orderdate", "Date"))
    return dated.groupBy(F.col("Year").cast("bigint").alias("year"), F.col("Month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.max("Day").cast("bigint").alias("last_day"), F.sum(F.dayofyear("Date")).alias("doy_sum"),
    )


def numeric_time_axes(spark, d):
    ev = table(spark, d, "events")
    days = timefn.days_since(F.col("ts"), "1950-01-01 00:00:00")
    back = timefn.from_days_since(days, "1950-01-01 00:00:00")
    return ev.select(
        "event_id", r(days).alias("days"), r(timefn.decimal_year(F.col("ts")), 8).alias("decimal_year"),
        F.date_format(back, "yyyy-MM-dd HH:mm:ss").alias("to_second"),
        r(timefn.hours_between(F.col("ts"), F.lit("2024-01-15").cast("timestamp_ntz")), 5).alias("hours"),
    )


def period_keys(spark, d):
    o = table(spark, d, "orders")
    date = F.col("o_orderdate")
    return o.select(
        "o_orderkey", timefn.month_key(date).alias("month"), timefn.composite8_key(date).alias("eight"),
        timefn.composite8_key(date, "as_written").alias("eight_written"), timefn.weekly_cycle(date).alias("cycle"),
        timefn.period_key(date, "1d").alias("d1"), timefn.period_key(date, "1m").alias("m1"), timefn.period_key(date, "1mNy").alias("mny"),
    )


def local_to_utc(spark, d):
    """Order dates spread over a day as wall times at four stations, through daylight-saving gaps."""
    o = table(spark, d, "orders")
    zones = {"0": "Australia/Sydney", "1": "Australia/Adelaide", "2": "Australia/Hobart", "3": "Australia/Perth"}
    zone = lookup_tz((F.col("o_orderkey") % 4).cast("string"), zones)
    local = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") % 288 * 300).cast("timestamp_ntz")
    return o.select("o_orderkey", F.date_format(timefn.utc_from_local(local, zone), "yyyy-MM-dd HH:mm:ss").alias("utc"))


def utc_to_local(spark, d):
    ev = table(spark, d, "events")
    local = timefn.local_from_utc(F.col("ts").cast("timestamp"), "Australia/Perth")
    return ev.select("event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("perth"))


def log10_squished(spark, d):
    line = table(spark, d, "lineitem")
    c = ocean.log10_squished(F.col("l_tax") * 10 - 0.2)
    return line.groupBy("l_suppkey").agg(r(F.sum(c), 5).alias("total"), F.count(c).alias("n"))


def kelvin(spark, d):
    return table(spark, d, "events").select("event_id", r(ocean.kelvin_to_celsius(F.col("value"))).alias("celsius"))


def sample_rows(spark, d):
    return op.sample_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 20, ["o_orderkey"], 42)


def draw_rows(spark, d):
    """A thousand draws with replacement from all orders."""
    return op.draw_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 1000, ["o_orderkey"], 42)


def describe(spark, d):
    line = table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice")).alias("price"), F.col("l_tax").alias("tax"),
    )
    out = describe_measures(line, ["quantity", "price", "tax"])
    return out.select("measure", "n", "n_missing", *[r(c).alias(c) for c in ("min", "p25", "p50", "p75", "max")], r("mean", 3).alias("mean"))


QUERIES = {f.__name__: f for f in (
    qc_mask_replicate_mean, qc_keep_mean, duplicate_report, duplicate_max, sample_universe, ctd_by_depth, ctd_surface, nutrient_mean,
    surface_pigment, nullsafe_water_quality_join, range_null, map_code, column_fallback, sample_code, paste_null, station_codes,
    identified_species_filter, complete_cases, bbox_filter, distinct_by_key, date_parts, numeric_time_axes, period_keys, local_to_utc,
    utc_to_local, log10_squished, kelvin, sample_rows, draw_rows,
)}
QUERIES["describe_measures"] = describe

_ZONE = """case o_orderkey % 4 when 0 then 'Australia/Sydney' when 1 then 'Australia/Adelaide' when 2 then 'Australia/Hobart' else 'Australia/Perth' end"""
_DESCRIBE = """select '{name}' as measure, count({c}) as n, count(*) - count({c}) as n_missing, round(min({c}), 6) as min,
  round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50, round(quantile_cont({c}, 0.75), 6) as p75,
  round(max({c}), 6) as max, round(avg({c}), 3) as mean from (select *, case when l_linenumber > 1 then l_extendedprice end as price_known from lineitem)"""

SQL = {
    "qc_mask_replicate_mean": """select l_orderkey, l_returnflag, round(avg(case when l_linenumber not in (3, 4, 9) then l_quantity end), 6) as quantity,
        avg(floor(l_extendedprice)) as price, round(coalesce(sum(case when l_linenumber not in (3, 4, 9) then l_discount end), 0), 6) as discount
      from lineitem group by all""",
    "qc_keep_mean": "select l_suppkey, round(avg(l_quantity), 6) as quantity from lineitem where l_linenumber - 1 in (0, 1, 2, 5, 8) group by l_suppkey",
    "duplicate_report": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all",
    "duplicate_max": "select max(n) as max_n from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)",
    "sample_universe": "select l_orderkey as trip, cast(l_linenumber as varchar) as depth from lineitem union select o_orderkey, 'WC' from orders",
    "ctd_by_depth": """select l_suppkey, cast(cast(round_even(l_extendedprice / 1000.0, 0) as bigint) as varchar) as depth_m, round(avg(l_quantity), 6) as t,
        round(avg(l_discount), 6) as s, round(avg(l_tax), 6) as chl from lineitem group by 1, 2""",
    "ctd_surface": """select l_suppkey, round(avg(l_quantity), 6) as t, round(avg(l_discount), 6) as s, round(avg(l_tax), 6) as chl
      from lineitem where l_extendedprice / 1000.0 < 15 group by 1""",
    "nutrient_mean": "select l_orderkey, round(avg(l_quantity), 6) as quantity, round(avg(l_tax), 6) as tax from lineitem group by 1",
    "surface_pigment": "select l_orderkey, round(avg(l_tax), 6) as chl from lineitem where l_quantity <= 25 group by 1",
    "nullsafe_water_quality_join": """with k as (select l_suppkey as trip, case when l_linenumber < 7 then l_linenumber end as depth, l_quantity from lineitem),
      m as (select trip, depth, avg(l_quantity) as q from k group by all)
      select u.trip, u.depth, round(q, 6) as quantity from (select distinct trip, depth from k) u
      left join m on u.trip = m.trip and u.depth is not distinct from m.depth""",
    "range_null": """select l_suppkey, count(case when l_quantity > 2 and l_quantity < 40 then 1 end) as n,
        sum(case when l_quantity > 2 and l_quantity < 40 then l_quantity end) as total from lineitem group by 1""",
    "map_code": "select case l_returnflag when 'A' then 'accepted' when 'R' then 'returned' else 'neither' end as state, count(*) as n from lineitem group by 1",
    "column_fallback": """select l_linenumber, round(sum(case when l_linenumber between 2 and 4 then l_tax else l_discount end), 4) as total,
        count(case when l_linenumber between 2 and 4 then 1 end) as n_measured from lineitem group by 1""",
    "sample_code": """select o_orderkey, 'N' || o_orderkey || '_' || case when o_orderkey % 5 = 0 then 'WC'
        when length(cast(o_custkey % 1200 as varchar)) >= 3 then cast(o_custkey % 1200 as varchar) else lpad(cast(o_custkey % 1200 as varchar), 3, '0') end as code from orders""",
    "paste_null": f"select coalesce(genus, 'NA') || ' ' || coalesce(species, 'NA') as name, count(*) as n from {roles.TAXA} group by 1",
    "station_codes": """with c as (select *, 'NRS' || upper(substring(o_orderpriority, 3, 3)) as site from orders),
      k as (select *, site || case when site = 'NRSLOW' then strftime(o_orderdate, '%Y%m%d_%H:%M') else strftime(o_orderdate, '%Y%m%d') end as code from c)
      select o_orderkey, code, substring(code, 4, 3) as station, substring(code, 1, 3) as prefix, split_part(o_orderpriority, ' ', 1) as word,
        o_orderpriority as part3, strftime(o_orderdate, '%H:%M:%S') as time from k""",
    "identified_species_filter": f"""select species, count(*) as n from {roles.TAXA}
      where {roles.IDENTIFIED} and species not like '%/%' and species <> '' group by 1""",
    "complete_cases": f"""select grp, count(*) as n from {roles.TAXA} where trip is not null and taxon is not null and genus is not null and species is not null
      and grp is not null and cells is not null and biovol is not null group by 1""",
    "bbox_filter": f"select pid, round(x, 6) as x, round(y, 6) as y from {roles.POINTS} where x between 1 and 6 and y between 0.5 and 4",
    "distinct_by_key": """select l_orderkey, l_shipdate, l_quantity, l_extendedprice from lineitem
      qualify row_number() over (partition by l_orderkey order by l_shipdate, l_quantity, l_extendedprice) = 1""",
    "date_parts": """select year(o_orderdate) as year, month(o_orderdate) as month, count(*) as n, max(day(o_orderdate)) as last_day,
        cast(sum(dayofyear(o_orderdate)) as bigint) as doy_sum from orders group by 1, 2""",
    "numeric_time_axes": """select event_id, round((epoch_us(ts) - epoch_us(timestamp '1950-01-01')) / 8.64e10, 6) as days,
        round(year(ts) + (epoch_us(ts) - epoch_us(date_trunc('year', ts)::timestamp)) / (case when year(ts) % 4 = 0 then 366 else 365 end * 8.64e10), 8) as decimal_year,
        strftime(to_timestamp(round_even(epoch_us(ts) / 1e6, 0)) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as to_second,
        round(abs(epoch_us(ts) - epoch_us(timestamp '2024-01-15')) / 3.6e9, 5) as hours from events""",
    "period_keys": """with b as (select o_orderkey, o_orderdate as t, dayofyear(o_orderdate) as doy, year(o_orderdate) as y,
        case when year(o_orderdate) % 4 = 0 then 366 else 365 end as ylen, least(dayofyear(o_orderdate), 361) as cap from orders),
      e as (select *, (doy - 1) // 8 * 8 + 1 as s8, case when round_even(cap / 8.0, 0) = 0 then 8 else round_even(cap / 8.0, 0) * 8 end as ew from b)
      select o_orderkey,
        strftime(t, '%Y') || printf('%03d', dayofyear(date_trunc('month', t))) || strftime(t, '%Y') || printf('%03d', dayofyear(last_day(t))) as month,
        strftime(t, '%Y') || printf('%03d', s8) || strftime(t, '%Y') || printf('%03d', least(s8 + 7, ylen)) as eight,
        strftime(t, '%Y') || printf('%03d', case when y in (2004, 2008, 2012, 2016) and cap > 360 then 366 when ew - 7 > 362 then 365 else cast(ew as bigint) - 7 end)
          || strftime(t, '%Y') || printf('%03d', cast(ew as bigint)) as eight_written,
        cast(round_even((round_even((epoch_us(t) - epoch_us(timestamp '1800-01-01')) / 8.64e10, 0) - 66410) / 7.0, 0) as bigint) as cycle,
        strftime(t, '%Y%m%d') as d1, strftime(t, '%Y%m') as m1, strftime(t, '%m') as mny from e""",
    "local_to_utc": f"""with w as (select o_orderkey, o_orderdate + to_seconds(cast(o_custkey % 288 * 300 as integer)) as t, {_ZONE} as z from orders),
      v as (select *, t at time zone z as one from w),
      u as (select *, case when (one - interval 1 hour) at time zone z = t then one - interval 1 hour else one end as utc from v)
      select o_orderkey, strftime(case when utc at time zone z <> t then (date_trunc('hour', t) at time zone z) at time zone 'UTC'
        else utc at time zone 'UTC' end, '%Y-%m-%d %H:%M:%S') as utc from u""",
    "utc_to_local": "select event_id, strftime(ts + interval 8 hours, '%Y-%m-%d %H:%M:%S') as perth from events",
    "log10_squished": """select l_suppkey, round(sum(case when l_tax * 10 - 0.2 > 0 then greatest(least(log10(l_tax * 10 - 0.2), 1), -1.5) end), 5) as total,
        count(case when l_tax * 10 - 0.2 > 0 then 1 end) as n from lineitem group by 1""",
    "kelvin": "select event_id, round(value - 273.15, 6) as celsius from events",
    "draw_rows": """with ranked as (select o_orderkey, o_totalprice, row_number() over (order by md5(cast(o_orderkey as varchar)), o_orderkey) - 1 as rank, count(*) over () as total from orders),
      draws as (select i as draw, cast('0x' || substr(md5(i || '|42'), 1, 15) as bigint) as number from range(1000) t(i))
      select draw, o_orderkey, o_totalprice from draws join ranked on rank = number % total""",
    "sample_rows": "select o_orderkey, o_totalprice from orders order by md5(o_orderkey || '|42'), o_orderkey limit 20",
    "describe_measures": " union all ".join(
        _DESCRIBE.format(name=n, c=c) for n, c in (("quantity", "l_quantity"), ("price", "price_known"), ("tax", "l_tax"))
    ),
}
