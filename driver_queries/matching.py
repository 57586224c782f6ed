"""Nearest-in-time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinedeck.functions.text import station_of_cast, station_of_trip
from brinedeck.operators import matching as op
from driver_queries import roles
from driver_queries.roles import r

TOLERANCE = {0: 15.0}


def _sides(spark, d):
    ev = roles.events(spark, d)
    purchases = ev.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("sample_ts"), F.col("event_id").alias("sample_id"))
    clicks = ev.filter("event_type = 'click'").select("user_id", F.col("ts").alias("cast_ts"), F.col("event_id").alias("cast_id"))
    return purchases, clicks


def nearest_cast(spark, d):
    purchases, clicks = _sides(spark, d)
    out = op.nearest_join(
        purchases, clicks, station="user_id", left_ts="sample_ts", right_ts="cast_ts", tolerance_by_station=TOLERANCE,
    )
    return out.select("user_id", "sample_id", "cast_id", r("gap_h").alias("gap_h"))


def nearest_times(spark, d):
    """Every sample time, matched or not."""
    purchases, clicks = _sides(spark, d)
    out = op.nearest_times(
        purchases, clicks, station="user_id", left_ts="sample_ts", right_ts="cast_ts", tolerance=8.0, tolerance_by_station=TOLERANCE,
    )
    return out.select("user_id", "sample_ts", "matched_ts", r("gap_h").alias("gap_h"))


def match_casts(spark, d):
    """Cast rows with the trip they belong to; station codes sit at the start of trips and inside cast codes."""
    purchases, clicks = _sides(spark, d)
    code = F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0")
    trips = purchases.select(F.concat(code, F.lit("-"), F.col("sample_id").cast("string")).alias("TripCode"), "sample_ts")
    casts = clicks.select("cast_id", "cast_ts", F.concat(F.lit("NRS"), code).alias("site"))
    out = op.match_casts(
        trips, casts, trip="TripCode", sample_ts="sample_ts", cast_ts="cast_ts", cast_id="cast_id",
        sample_station=station_of_trip(F.col("TripCode")), cast_station=station_of_cast(F.col("site")),
        tolerance_by_station={"000": 15.0},
    )
    return out.select("cast_id", "site", "TripCode")


QUERIES = {f.__name__: f for f in (nearest_cast, nearest_times, match_casts)}

_PAIRS = """l as (select {st} as user_id, ts, event_id as sample_id from events where event_type = 'purchase'),
  k as (select {st} as user_id, ts as cts, event_id as cast_id from events where event_type = 'click'),
  near as (select l.user_id, l.sample_id, l.ts, k.cts, k.cast_id, abs(epoch_us(l.ts) - epoch_us(k.cts)) as gap from l join k using (user_id)
    where abs(epoch_us(l.ts) - epoch_us(k.cts)) / 3.6e9 <= case when user_id = 0 then 15 else {tol} end
    qualify rank() over (partition by user_id, sample_id order by gap, cts) = 1)"""

SQL = {
    "nearest_cast": f"with {_PAIRS.format(tol=3, st='user_id')} select user_id, sample_id, cast_id, round(gap / 3.6e9, 6) as gap_h from near",
    "nearest_times": f"""with {_PAIRS.format(tol=8, st='user_id')}
      select distinct l.user_id, l.ts as sample_ts, near.cts as matched_ts, round(near.gap / 3.6e9, 6) as gap_h from l left join near using (user_id, sample_id)""",
    "match_casts": f"""with {_PAIRS.format(tol=3, st='user_id % 1000')}
      select k.cast_id, 'NRS' || lpad(cast(k.user_id as varchar), 3, '0') as site,
        case when near.sample_id is not null then lpad(cast(k.user_id as varchar), 3, '0') || '-' || near.sample_id end as "TripCode"
      from k left join near using (cast_id)""",
}
