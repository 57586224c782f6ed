"""Match-up of points to long grid tables.

A grid is one row per (product, period, lon_idx, lat_idx).  Points get their
cell as integer columns; the distinct cells are matched to the grid with an
equi-join and the result goes back to the points, so that many samples at one
station cost the grid side one lookup.  The points' distinct periods, a set that
the calendar bounds, filter the grid as a subquery: where the grid is stored by
period, only those folders are opened, whatever kind of join is chosen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.functions.axes import RegularAxis
from brinedeck.functions.missing import nan_to_null
from brinedeck.functions.ocean import bilinear_blend, harmonic


def with_cell(points: DataFrame, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis) -> DataFrame:
    """Index of the nearest node on either axis."""
    return points.withColumns({"_x": lon_axis.nearest(F.col(lon)), "_y": lat_axis.nearest(F.col(lat))})


def nearest_on_axis(points: DataFrame, axis: DataFrame, *, coord: str, axis_coord: str, idx: str, bin_width: float) -> DataFrame:
    """Nearest node of an irregular axis, as an equi-join on coordinate bins.

    The axis table has one row per node.  Each node owns the interval up to the
    midpoints of its neighbours, entered once per bin it touches.  Points
    beyond the ends take the end node.
    """
    ends = axis.agg(F.struct(F.min(axis_coord).cast("double").alias("low"), F.max(axis_coord).cast("double").alias("high"))).scalar()
    nodes = _owned_intervals(axis, axis_coord, idx).withColumns({
        "_lo": F.coalesce("_lo", ends["low"] - 1.0),
        "_hi": F.coalesce("_hi", ends["high"]),
    })
    step = F.lit(float(bin_width))
    binned = nodes.withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col("_lo") / step), F.floor(F.col("_hi") / step)))
    )
    clamped = F.greatest(F.least(F.col(coord), ends["high"]), ends["low"])
    located = points.withColumn("_v", F.when(F.col(coord).isNotNull(), clamped)).withColumn("_bin", F.floor(F.col("_v") / step))
    owns = (located["_bin"] == binned["_bin"]) & (located["_v"] > binned["_lo"]) & (located["_v"] <= binned["_hi"])
    return located.join(binned, owns, "left").drop("_v", "_bin", "_lo", "_hi")


def _owned_intervals(axis: DataFrame, axis_coord: str, idx: str) -> DataFrame:
    order = W.orderBy(axis_coord)
    c = F.col(axis_coord)
    return axis.select(
        F.col(idx),
        ((c + F.lag(c).over(order)) / 2).alias("_lo"),
        ((c + F.lead(c).over(order)) / 2).alias("_hi"),
    )


def only_periods(grid: DataFrame, points: DataFrame, *periods: str) -> DataFrame:
    """Rows of ``grid`` in the periods (one or more columns together) that ``points`` have."""
    if not periods:
        return grid
    wanted = points.select(F.struct(*[F.col(p).cast(grid.schema[p].dataType).alias(p) for p in periods]).alias("p")).agg(F.collect_set("p"))
    return grid.filter(F.array_contains(wanted.scalar(), F.struct(*periods)))


def join_windows(cells: DataFrame, layers: DataFrame, by: Sequence[str], lon_axis: RegularAxis, lat_axis: RegularAxis, n: int) -> DataFrame:
    """Every cell (``by``, ``_x``, ``_y``) with the grid rows of its n x n window, as an equi-join on tiles.

    The index plane is cut into tiles of n x n nodes.  A window reaches at most two tiles on either
    axis, so a cell is four rows at most whatever n is, and a grid row is one.
    """
    if n == 1:
        return cells.withColumns({"lon_idx": F.col("_x"), "lat_idx": F.col("_y")}).join(layers, [*by, "lon_idx", "lat_idx"])
    side = F.lit(float(n))
    corner = {"_x0": F.col("_x") - n // 2, "_y0": F.col("_y") - n // 2}

    def reached(first: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(first) / side), F.floor((F.col(first) + n - 1) / side)))

    asked = cells.withColumns(corner).withColumn("_tx", reached("_x0")).withColumn("_ty", reached("_y0"))
    inside = F.col("lon_idx").between(0, lon_axis.size - 1) & F.col("lat_idx").between(0, lat_axis.size - 1)
    tiled = layers.filter(inside).withColumns({"_tx": F.floor(F.col("lon_idx") / side), "_ty": F.floor(F.col("lat_idx") / side)})
    near = F.col("lon_idx").between(F.col("_x0"), F.col("_x0") + n - 1) & F.col("lat_idx").between(F.col("_y0"), F.col("_y0") + n - 1)
    return asked.join(tiled, [*by, "_tx", "_ty"]).filter(near)


def match_grid(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    products: Mapping[str, str], period: str | None = None, res_spat: int = 1, value: str = "value",
) -> DataFrame:
    """One column per product: value at the nearest cell, or the mean of an n x n window.

    ``products`` maps output column to product name.  The window starts
    ``floor(n / 2)`` cells before the nearest cell, so for even n it reaches one
    cell further down than up; missing values and cells beyond the grid are
    left out.  ``period`` names the column shared with the grid.  Points whose
    period has no layer keep NULL.
    """
    by = [period] if period else []
    located = with_cell(points, lon, lat, lon_axis, lat_axis)
    cells = located.select(*by, "_x", "_y").distinct()
    layers = only_periods(grid.filter(F.col("product").isin(*products.values())), points, *by)
    means = join_windows(cells, layers, by, lon_axis, lat_axis, res_spat).groupBy(*by, "_x", "_y").agg(*[
        F.avg(nan_to_null(F.when(F.col("product") == name, F.col(value)))).alias(out)
        for out, name in products.items()
    ])
    return located.join(means, [*by, "_x", "_y"], "left").select(*points.columns, *products)


def match_altimetry(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    year: str, doy: str, grid_doy: str = "slice_doy",
    measures: Sequence[str] = ("GSLA", "GSL", "UCUR", "VCUR"), res_spat: int = 1, slices: DataFrame | None = None,
) -> DataFrame:
    """Sea-level and current measures of the slice nearest in day of year within the point's year.

    The earlier slice wins a tie.  ``Longitude_Actual`` and ``Latitude_Actual``
    are the coordinates of the first cell of the window (the cell itself for a
    single cell).  A year has at most 366 slices, which bounds the slice search.
    ``slices`` is the calendar of the grid (year, day of slice); without it the
    calendar is read from the grid's two columns in the points' years, which
    are folder names where the grid is stored by them.
    """
    located = with_cell(points, lon, lat, lon_axis, lat_axis)
    if slices is None:
        slices = only_periods(grid, points, year).select(year, grid_doy).distinct()
    gap = F.abs(F.col(doy) - F.col(grid_doy))
    nearest = (
        points.select(year, doy).distinct().join(slices, year)
        .groupBy(year, doy).agg(F.min_by(grid_doy, F.struct(gap, F.col(grid_doy))).alias(grid_doy))
    )
    located = located.join(nearest, [year, doy], "left")
    by = [year, grid_doy]
    cells = located.select(*by, "_x", "_y").distinct()
    half = res_spat // 2
    layers = only_periods(grid, nearest, *by)
    means = join_windows(cells, layers, by, lon_axis, lat_axis, res_spat).groupBy(*by, "_x", "_y").agg(
        *[F.avg(nan_to_null(F.col(m))).alias(m) for m in measures]
    )
    return located.join(means, [*by, "_x", "_y"], "left").select(
        *points.columns, *measures,
        lon_axis.coord(F.col("_x") - half).alias("Longitude_Actual"),
        lat_axis.coord(F.col("_y") - half).alias("Latitude_Actual"),
    )


def bilinear_match(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    values: Mapping[str, str], period: str | None = None,
) -> DataFrame:
    """Blend of the four nodes around each point; NULL if a needed node is missing.

    ``values`` maps output columns to grid columns, all blended from one
    lookup.  A point on a node line is interpolated along the other axis only.
    """
    by = [period] if period else []
    located = points.withColumns({
        "_x1": lon_axis.at_or_below(F.col(lon)), "_x2": lon_axis.at_or_above(F.col(lon)),
        "_y1": lat_axis.at_or_below(F.col(lat)), "_y2": lat_axis.at_or_above(F.col(lat)),
    })
    box = [*by, "_x1", "_x2", "_y1", "_y2"]
    corners = F.array(*[
        F.struct(F.lit(f"{i}{j}").alias("corner"), F.col(f"_x{i}").alias("lon_idx"), F.col(f"_y{j}").alias("lat_idx"))
        for i in (1, 2) for j in (1, 2)
    ])
    nodes = located.select(*box).dropna(subset=box[-4:]).distinct().select(*box, F.inline(corners))
    found = nodes.join(
        only_periods(grid, points, *by).select(*by, "lon_idx", "lat_idx", *[F.col(c).cast("double").alias(f"_v_{out}") for out, c in values.items()]),
        [*by, "lon_idx", "lat_idx"],
    )
    wide = found.groupBy(*box).agg(*[
        F.max(F.when(F.col("corner") == c, nan_to_null(F.col(f"_v_{out}")))).alias(f"_{out}_{c}")
        for out in values for c in ("11", "21", "12", "22")
    ])
    blends = [
        bilinear_blend(
            F.col(lon), F.col(lat),
            lon_axis.coord(F.col("_x1")), lon_axis.coord(F.col("_x2")),
            lat_axis.coord(F.col("_y1")), lat_axis.coord(F.col("_y2")),
            *[F.col(f"_{out}_{c}") for c in ("11", "21", "12", "22")],
        ).alias(out)
        for out in values
    ]
    return located.join(wide, box, "left").select(*points.columns, *blends)


def regrid_linear(grid: DataFrame, target: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis, value: str = "value") -> DataFrame:
    """Values of one lattice at the nodes of another by linear interpolation."""
    return bilinear_match(target, grid, lon=lon, lat=lat, lon_axis=lon_axis, lat_axis=lat_axis, values={value: value})


def lookup_cells(points: DataFrame, grid: DataFrame, keys: Mapping[str, Column], columns: Sequence[str], period: str | None = None) -> DataFrame:
    """Left equi-join of points to grid cells by computed key columns.

    The distinct cells are looked up and the few rows found go back to the
    points; ``period`` names the key by which the grid is stored.
    """
    by = [f"_k_{k}" for k in keys]
    located = points.withColumns(dict(zip(by, keys.values(), strict=True)))
    layers = only_periods(grid, points, period) if period else grid
    cells = layers.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *columns)
    found = located.select(*by).dropna().distinct().join(cells, by)
    return located.join(found, by, "left").select(*points.columns, *columns)


def bracket_match(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    value: str = "value", period: str | None = None,
) -> DataFrame:
    """Value at the corner with the last longitude not above and the first latitude not below the point."""
    keys = {"lon_idx": lon_axis.at_or_below(F.col(lon)), "lat_idx": lat_axis.at_or_above(F.col(lat))}
    if period:
        keys[period] = F.col(period)
    return lookup_cells(points, grid, keys, [value], period)


def window_first_match(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    half: float, value: str = "value", period: str | None = None,
) -> DataFrame:
    """Value of the first cell strictly within ``half`` degrees on both axes."""
    keys = {"lon_idx": lon_axis.first_within(F.col(lon), half), "lat_idx": lat_axis.first_within(F.col(lat), half)}
    if period:
        keys[period] = F.col(period)
    return lookup_cells(points, grid, keys, [value], period)


def match_climatology(
    points: DataFrame, grid: DataFrame, *, lon: str, lat: str, doy: str, lon_axis: RegularAxis, lat_axis: RegularAxis,
    terms: Sequence[str] = ("mean", "an_cos", "an_sin", "sa_cos", "sa_sin"), out: str = "value",
) -> DataFrame:
    """Climatological mean of the nearest node and its value on the point's day of year.

    Coordinates round half to even, as the node spacing divides them.
    """
    def node(axis: RegularAxis, c: str) -> Column:
        idx = F.bround(axis.position(F.col(c))).cast("int")
        return F.when((idx >= 0) & (idx < axis.size), idx)

    found = lookup_cells(points, grid, {"lon_idx": node(lon_axis, lon), "lat_idx": node(lat_axis, lat)}, list(terms))
    value = harmonic(F.col(doy), *[F.col(t) for t in terms])
    return found.select(*points.columns, F.col(terms[0]), value.alias(out))


def weekly_slices(slices: DataFrame, day: str, origin: int) -> DataFrame:
    """Map from 7-day cycle number to the first slice after that cycle's day.

    ``slices`` has one row per slice day, about 52 a year.  A slice serves the
    cycles from the previous slice's day up to, not including, its own.
    """
    prev = F.lag(day).over(W.orderBy(day))
    first = F.ceil((F.coalesce(prev, F.col(day) - 7) - origin) / 7.0)
    last = F.ceil((F.col(day) - origin) / 7.0) - 1
    return (
        slices.select(day, first.alias("_a"), last.alias("_b")).filter("_b >= _a")
        .select(F.explode(F.sequence("_a", "_b")).alias("cycle"), day)
    )
