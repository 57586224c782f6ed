"""Mooring, raster-series and region products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.fixed_values import FALLBACK_REGIONS
from brinedeck.functions.timefn import decimal_year
from brinedeck.operators.geo import region_bbox_fallback, region_boxes, region_join
from brinedeck.operators.grid import block_mean, box_series, cell_trend, depth_bin_series, doy_climatology
from brinedeck.operators.quality import in_bbox
from brinedeck.operators.surface import fitted_surface


def mooring_products(series: DataFrame, *, nx: int = 200, ny: int = 200, cells: tuple[int, int] = (1, 5), levels: int = 8) -> dict[str, DataFrame]:
    """Contour grid, depth-bin series and day-of-year climatology of all sites at once.

    ``series`` has site, time, depth and temp.  The contour grid is the surface
    fitted to each site over its range of time (as decimal year) and depth.
    """
    timed = series.withColumn("decimal_year", decimal_year(F.col("time")))
    cols = {"site": "site", "time": "time", "depth": "depth", "value": "temp"}
    return {
        "contour": fitted_surface(timed, x="decimal_year", y="depth", value="temp", nx=nx, ny=ny, by=["site"], cells=cells, levels=levels),
        "series": depth_bin_series(series, **cols),
        "climatology": doy_climatology(series, **cols),
    }


def trend_map(grid: DataFrame, bounds: tuple[float, float, float, float], layer: str) -> DataFrame:
    """Slope of every cell of a box over its layers."""
    return cell_trend(in_bbox(grid, "lon", "lat", bounds), cell=["lon_idx", "lat_idx"], time=layer)


def station_series(grid: DataFrame, lon: float, lat: float, half: float = 0.01) -> DataFrame:
    """Mean of the pixels around a station for every time."""
    return box_series(grid, bounds=(lon - half, lon + half, lat - half, lat + half), time="time")


def coarse_map(grid: DataFrame, bounds: tuple[float, float, float, float], k: int = 4) -> DataFrame:
    """Block means of a box, without empty blocks."""
    return block_mean(in_bbox(grid, "lon", "lat", bounds), by=[], k=k)


def tag_regions(points: DataFrame, layers: dict[str, tuple[DataFrame, Sequence[str]]], *, x: str = "Longitude", y: str = "Latitude") -> DataFrame:
    """Attributes of every region layer for each point; ``layers`` maps a label to (edges, attributes)."""
    out = points
    for edges, attributes in layers.values():
        out = region_join(out, edges, x=x, y=y, region=attributes)
    return out


def bio_regions(points: DataFrame, edges: DataFrame, *, x: str = "Longitude", y: str = "Latitude", region: str = "BioRegion") -> DataFrame:
    """Marine region of each point, with the boxes of four regions for points just outside all."""
    tagged = region_join(points, edges, x=x, y=y, region=[region])
    return region_bbox_fallback(tagged, x=x, y=y, region=region, boxes=region_boxes(edges, region, FALLBACK_REGIONS))
