"""Quality control, replicate means and key checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.fixed_values import BAD_FLAGS, GOOD_FLAGS, SURFACE_CAST_DEPTH_M
from brinedeck.functions.missing import is_in, mask_flagged, nan_to_null, sum_or_zero


def qc_mask(df: DataFrame, flags: Mapping[str, str], bad: Iterable[int] = BAD_FLAGS) -> DataFrame:
    """NULL every measure whose flag column marks it bad."""
    return df.withColumns({m: mask_flagged(F.col(m), F.col(f), bad) for m, f in flags.items()})


def qc_keep(df: DataFrame, flag: str, good: Iterable[int] = GOOD_FLAGS) -> DataFrame:
    """Rows whose flag is good; an absent flag is dropped."""
    return df.filter(is_in(F.col(flag), good))


def replicate_mean(df: DataFrame, keys: Sequence[str], means: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row per key: mean of each measure, or the sum for those named in ``sums``."""
    aggs = [F.avg(nan_to_null(F.col(m).cast("double"))).alias(m) for m in means]
    aggs += [sum_or_zero(nan_to_null(F.col(m).cast("double"))).alias(m) for m in sums]
    return df.groupBy(*keys).agg(*aggs)


def mean_by_key(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Means per key under new names, ``{output: input}``, over the rows in ``where``."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).agg(
        *[F.avg(nan_to_null(F.col(src).cast("double"))).alias(out) for out, src in measures.items()]
    )


def ctd_by_depth(df: DataFrame, key: str, depth: str, measures: Mapping[str, str], out_depth: str = "SampleDepth_m") -> DataFrame:
    """Cast means per sample and depth rounded half to even, with the depth as text."""
    rounded = F.bround(F.col(depth)).cast("bigint").cast("string")
    return mean_by_key(df.withColumn(out_depth, rounded), [key, out_depth], measures)


def ctd_surface(df: DataFrame, key: str, depth: str, measures: Mapping[str, str], cut: float = SURFACE_CAST_DEPTH_M) -> DataFrame:
    """Cast means per sample above ``cut`` metres."""
    return mean_by_key(df, [key], measures, F.col(depth) < cut)


def sample_universe(keys: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Distinct keys found in any of the tables."""
    return reduce(DataFrame.unionByName, [t.select(*keys) for t in tables]).distinct()


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; every ``n`` is 1 in a table without replicates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_max(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_report(df, keys).agg(F.max("n").alias("max_n"))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL in ``columns`` (default: in any column)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in a stated order, by aggregation rather than a sort."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.`{c}`").alias(c) for c in rest])


def in_bbox(df: DataFrame, x: str, y: str, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Rows inside (xmin, xmax, ymin, ymax), edges included; plain comparisons, so the scan gets them."""
    x0, x1, y0, y1 = bounds
    return df.filter(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))


def require_date(df: DataFrame, date: str = "Date") -> DataFrame:
    """Check that a date or its parts are present; add the parts if they are not."""
    parts = {"Day", "Month", "Year"}
    if parts <= set(df.columns):
        return df
    if date not in df.columns:
        raise ValueError(f"need a {date} column, or Day, Month and Year")
    return df.withColumns({"Day": F.dayofmonth(date), "Month": F.month(date), "Year": F.year(date)})


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in an order that looks random but depends only on the key and the seed."""
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.orderBy(draw, *key).limit(n)


def draw_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42, digits: int = 4) -> DataFrame:
    """``n`` draws with replacement: the row of each draw (from 0), so that rows may repeat.

    Rows are ranked by a hash of their key, and each draw asks for a rank that depends on the seed only.
    Hash prefixes of ``digits`` make 16 ** digits buckets whose sizes, added up, tell each draw
    its bucket; only rows of buckets that are drawn are put in order. An empty table gives no row.
    """
    place = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    rows = df.withColumn("_place", place).withColumn("_bucket", F.substr("_place", F.lit(1), F.lit(digits)))
    sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    width = F.greatest(F.lit(1), F.floor(total / 16**digits))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    spans = sizes.select("_bucket", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")).withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("_start") / width), F.floor((F.col("_start") + F.col("_n") - 1) / width)))
    )
    number = F.conv(F.substr(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))), F.lit(1), F.lit(15)), 16, 10).cast("long")
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), (number % total).alias("_rank")).withColumn("_block", F.floor(F.col("_rank") / width))
    asked = draws.join(spans, "_block").filter("_rank >= _start and _rank < _start + _n").select("draw", "_bucket", (F.col("_rank") - F.col("_start") + 1).alias("_at"))
    ordered = W.partitionBy("_bucket").orderBy("_place", *key)
    numbered = rows.join(asked.select("_bucket").distinct(), "_bucket", "left_semi").withColumn("_at", F.row_number().over(ordered))
    return numbered.join(asked, ["_bucket", "_at"]).select("draw", *df.columns)
