"""Match-up chains of points with satellite, bathymetry and climatology grids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import WEEKLY_EPOCH, WEEKLY_ORIGIN_DAY
from brinedeck.functions.axes import RegularAxis
from brinedeck.functions.ocean import harmonic, kelvin_to_celsius
from brinedeck.functions.timefn import composite8_key, days_since, month_key, period_key, weekly_cycle
from brinedeck.operators import gridmatch
from brinedeck.operators.quality import in_bbox, require_date


def satellite_chain(
    points: DataFrame, grids: Mapping[str, tuple[DataFrame, RegularAxis, RegularAxis, list[str]]], *,
    lon: str = "Longitude", lat: str = "Latitude", date: str = "Date", resolution: str = "1d", res_spat: int = 10,
) -> DataFrame:
    """Add one column ``<product>_<resolution>`` per product of each grid.

    ``grids`` maps a label to (grid, longitude axis, latitude axis, products);
    each grid has ``period`` in the form of ``period_key``.
    """
    out = require_date(points, date)
    for grid, lon_axis, lat_axis, products in grids.values():
        keyed = out.withColumn("period", period_key(F.col(date), resolution))
        out = gridmatch.match_grid(
            keyed, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, period="period", res_spat=res_spat,
            products={f"{p}_{resolution}": p for p in products},
        ).drop("period")
    return out


def add_altimetry(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, date: str, lon_axis: RegularAxis, lat_axis: RegularAxis, res_spat: int = 1, slices: DataFrame | None = None) -> DataFrame:
    """Add sea-level measures; the grid has ``year`` and ``slice_doy`` per slice, ``slices`` is its calendar."""
    keyed = points.withColumns({"year": F.year(date), "doy": F.dayofyear(date)})
    return gridmatch.match_altimetry(
        keyed, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, year="year", doy="doy", res_spat=res_spat, slices=slices,
    ).drop("year", "doy")


def daily_sst(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, date: str, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    """Bilinear daily temperature, from kelvin to Celsius."""
    keyed = points.withColumn("period", period_key(F.col(date), "1d"))
    out = gridmatch.bilinear_match(keyed, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, period="period", values={"sst_C": "value"})
    return out.withColumn("sst_C", kelvin_to_celsius(F.col("sst_C"))).drop("period")


def bathymetry(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    return gridmatch.bilinear_match(points, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, values={"height": "value"})


def weekly_sst(points: DataFrame, grid: DataFrame, slices: DataFrame, *, lon: str, lat: str, date: str, day: str, origin: int, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    """Corner value of the first weekly slice after the point's 7-day cycle; points up to the origin day are dropped."""
    keyed = points.filter(F.bround(days_since(F.col(date), WEEKLY_EPOCH)) > WEEKLY_ORIGIN_DAY).withColumn("cycle", weekly_cycle(F.col(date)))
    dated = keyed.join(gridmatch.weekly_slices(slices, day, origin), "cycle", "left").drop("cycle")
    return gridmatch.bracket_match(dated, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, period=day)


def composite_corner(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, date: str, span: str, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    """Corner value of the 8-day (``8d``) or monthly (``1m``) composite that holds the date."""
    key = {"8d": composite8_key, "1m": month_key}[span](F.col(date))
    keyed = points.withColumn("period", key)
    return gridmatch.bracket_match(keyed, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, period="period").drop("period")


def monthly_window(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, date: str, half: float, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    """First cell of the monthly composite within ``half`` degrees (turbidity, dust index)."""
    keyed = points.withColumn("period", month_key(F.col(date)))
    return gridmatch.window_first_match(
        keyed, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, half=half, period="period",
    ).drop("period")


def climatology_at_points(points: DataFrame, grid: DataFrame, *, lon: str, lat: str, doy: str, lon_axis: RegularAxis, lat_axis: RegularAxis, interpolate: bool = False) -> DataFrame:
    """Climatology on each point's day of year, at the nearest node or blended from four.

    The harmonic is linear in its five terms, so blending the terms and then
    evaluating equals blending four evaluated corners.
    """
    where = {"lon": lon, "lat": lat, "lon_axis": lon_axis, "lat_axis": lat_axis}
    if not interpolate:
        return gridmatch.match_climatology(points, grid, doy=doy, **where)
    terms = ("mean", "an_cos", "an_sin", "sa_cos", "sa_sin")
    out = gridmatch.bilinear_match(points, grid, values={f"_{t}": t for t in terms}, **where)
    value = harmonic(F.col(doy), *[F.col(f"_{t}") for t in terms])
    return out.withColumn("value", value).drop(*[f"_{t}" for t in terms])


def climatology_layer(grid: DataFrame, doy: int) -> DataFrame:
    """Whole climatology grid on one day of year."""
    terms = [F.col(t) for t in ("mean", "an_cos", "an_sin", "sa_cos", "sa_sin")]
    return grid.withColumn("value", harmonic(F.lit(doy), *terms))


def regional_layer(grid: DataFrame, bounds: tuple[float, float, float, float], target: DataFrame | None = None, *, lon_axis: RegularAxis | None = None, lat_axis: RegularAxis | None = None) -> DataFrame:
    """Box cut of a layer, or its linear regrid onto target nodes (``lon``, ``lat``)."""
    if target is None:
        return in_bbox(grid, "lon", "lat", bounds)
    nodes = in_bbox(target, "lon", "lat", bounds)
    return gridmatch.regrid_linear(grid, nodes, lon="lon", lat="lat", lon_axis=lon_axis, lat_axis=lat_axis)
