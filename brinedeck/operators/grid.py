"""Long grid and mooring tables: reshaping, bins, climatologies, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.functions.missing import nan_to_null
from brinedeck.functions.ocean import depth_bin
from brinedeck.operators.quality import in_bbox


def melt_columns(wide: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long; missing values are dropped."""
    return wide.unpivot(list(ids), list(columns), name, value).filter(nan_to_null(F.col(value).cast("double")).isNotNull())


def melt_array(cubes: DataFrame, ids: Sequence[str], array: str, width: int, value: str = "value") -> DataFrame:
    """Row-major array column to (lat_idx, lon_idx, value) rows."""
    return cubes.select(*ids, F.posexplode(array).alias("_p", "_v")).select(
        *ids,
        F.floor(F.col("_p") / width).cast("int").alias("lat_idx"),
        (F.col("_p") % width).cast("int").alias("lon_idx"),
        F.col("_v").cast("double").alias(value),
    )


def depth_bin_series(df: DataFrame, *, site: str, time: str, depth: str, value: str) -> DataFrame:
    """Mean value per site, depth bin and time; depths outside the bins are dropped."""
    rows = df.withColumn("DepthBin", depth_bin(F.col(depth))).dropna(subset=["DepthBin", time, value])
    return rows.groupBy(site, "DepthBin", time).agg(F.avg(value).alias(value))


def doy_climatology(df: DataFrame, *, site: str, time: str, depth: str, value: str) -> DataFrame:
    """Mean value per site, depth bin and day of year."""
    rows = df.withColumns({"DepthBin": depth_bin(F.col(depth)), "DOY": F.dayofyear(time)})
    return rows.dropna(subset=["DepthBin", "DOY", value]).groupBy(site, "DepthBin", "DOY").agg(F.avg(value).alias(value))


def box_series(grid: DataFrame, *, bounds: tuple[float, float, float, float], time: str, lon: str = "lon", lat: str = "lat", value: str = "value") -> DataFrame:
    """Mean over a box for every time."""
    return in_bbox(grid, lon, lat, bounds).groupBy(time).agg(F.avg(nan_to_null(F.col(value))).alias(value))


def block_mean(grid: DataFrame, *, by: Sequence[str], k: int = 4, value: str = "value") -> DataFrame:
    """k x k cells to one; blocks without any value are dropped."""
    return grid.groupBy(
        *by, F.floor(F.col("lon_idx") / k).cast("int").alias("lon_blk"), F.floor(F.col("lat_idx") / k).cast("int").alias("lat_blk"),
    ).agg(F.avg(nan_to_null(F.col(value))).alias(value)).dropna(subset=[value])


def cell_trend(grid: DataFrame, *, cell: Sequence[str], time: str, value: str = "value") -> DataFrame:
    """Least-squares slope of each cell over its layers; NULL where the first layer of the stack has no value, or no row, for it."""
    opening = grid.agg(F.min(time)).scalar()
    first = F.max(F.when(F.col(time) == F.col("_opening"), F.col(value)))
    return grid.withColumn("_opening", opening).groupBy(*cell).agg(
        F.when(first.isNotNull(), F.regr_slope(F.col(value), F.col(time).cast("double"))).alias("slope")
    )


def regrid_bins(
    df: DataFrame, *, x: str, y: str, value: str, nx: int = 200, ny: int = 200,
    by: Sequence[str] = (), x_range: tuple[float, float] | None = None, y_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Mean of scattered values on an nx by ny grid of equal bins over the range of each ``by`` group.

    One aggregation finds the ranges that are not given; it meets the rows by
    group.  The upper edge belongs to the last bin.
    """
    asked = [c for c, given in ((x, x_range), (y, y_range)) if given is None]
    rows = df.select(*by, x, y, value)
    if asked:
        ends = [f(c).cast("double").alias(f"_{end}_{c}") for c in asked for f, end in ((F.min, "low"), (F.max, "high"))]
        if by:
            found = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(*ends)
            same = None
            for c in by:
                one = F.col(c).eqNullSafe(F.col(f"_by_{c}"))
                same = one if same is None else same & one
            rows = rows.join(found, same)
        else:
            rows = rows.withColumn("_ends", df.agg(F.struct(*ends)).scalar()).select(*rows.columns, "_ends.*")

    def bin_of(c: str, given: tuple[float, float] | None, n: int) -> Column:
        low, high = (F.col(f"_low_{c}"), F.col(f"_high_{c}")) if given is None else (F.lit(float(given[0])), F.lit(float(given[1])))
        raw = F.coalesce(F.floor(F.try_divide((F.col(c) - low) * n, high - low)), F.lit(0)).cast("int")
        return F.when(F.col(c).between(low, high), F.least(raw, F.lit(n - 1)))

    binned = rows.select(*by, bin_of(x, x_range, nx).alias("x_bin"), bin_of(y, y_range, ny).alias("y_bin"), value)
    return binned.dropna(subset=["x_bin", "y_bin", value]).groupBy(*by, "x_bin", "y_bin").agg(F.avg(value).alias(value))


def monthly_spine(df: DataFrame, *, by: Sequence[str], time: str, out: str = "month") -> DataFrame:
    """Every month from the first to the last of each group."""
    bounds = df.groupBy(*by).agg(F.trunc(F.min(time), "month").alias("_a"), F.trunc(F.max(time), "month").alias("_b"))
    return bounds.select(*by, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(out))
