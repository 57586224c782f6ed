"""Mooring catalogue, file summary and one-depth series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.functions.text import path_part


def mooring_catalog(catalog: DataFrame, site: str | None = None, kind: str = "gridded_timeseries") -> DataFrame:
    """Delayed-mode files of a site whose location names the product kind."""
    rows = catalog.filter((F.col("realtime") == "FALSE") & F.col("url").contains(kind))
    return rows if site is None else rows.filter(F.col("site_code") == site)


def mooring_summary(series: DataFrame, *, site: str, source: str, lat: str, lon: str, time: str, depth: str) -> DataFrame:
    """Per source file: site, facility, mid position, time cover and its nominal depths."""
    depths = F.array_join(F.transform(F.sort_array(F.collect_set(depth)), lambda d: d.cast("string")), ", ")
    return series.groupBy(source, site).agg(
        ((F.min(lat) + F.max(lat)) / 2).alias("latitude"),
        ((F.min(lon) + F.max(lon)) / 2).alias("longitude"),
        F.min(time).alias("time_start"), F.max(time).alias("time_end"),
        depths.alias("depths"),
    ).withColumn("facility", path_part(F.col(source), 3))


def mooring_series(
    series: DataFrame, *, site: str, site_value, depth: str, depth_value: float, time: str, value: str,
    start: str = "1970-01-01", end: str | None = None,
) -> DataFrame:
    """Values at one nominal depth in a time window; all filters reach the scan.

    An unavailable depth is an error when the query runs; it names the range of
    depths at the site and the nearest one, from one aggregation over that column.
    """
    at_site = series.filter(F.col(site) == site_value)
    wanted = F.lit(depth_value).cast(series.schema[depth].dataType)
    found = at_site.agg(
        F.count_if(F.col(depth) == wanted).alias("n"), F.min(depth).alias("low"), F.max(depth).alias("high"),
        F.min_by(depth, F.abs(F.col(depth) - wanted)).alias("near"),
    )
    message = F.format_string(
        f"depth {depth_value} m is not available at {site_value}; available: %s to %s, nearest %s", *[F.col(c).cast("string") for c in ("low", "high", "near")],
    )
    known = found.select(F.when(F.col("n") > 0, F.lit(True)).otherwise(F.raise_error(message)).alias("ok")).scalar()
    rows = at_site.filter((F.col(depth) == depth_value) & (F.col(time) >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        rows = rows.filter(F.col(time) <= F.lit(end).cast("timestamp_ntz"))
    return rows.filter(known).select(time, value)


def series_file_name(series: DataFrame, *, site: str, depth: float, time: str, variable: str = "TEMP") -> str:
    """``<site>_<variable>_<depth>m_<first day>-<last day>`` of a series."""
    first, last = series.agg(F.min(time), F.max(time)).first()
    return f"{site}_{variable}_{depth:g}m_{first:%Y%m%d}-{last:%Y%m%d}"


def gridded_from_matrix(wide: DataFrame, time: str, depth_columns: list[str]) -> DataFrame:
    """Depth by time matrix to long rows, dropping missing values; depths come from the column names."""
    long = wide.unpivot([time], [F.col(f"`{c}`") for c in depth_columns], "_depth", "value").filter(F.col("value").isNotNull())
    return long.select(time, F.col("_depth").cast("double").alias("depth"), F.col("value"))


