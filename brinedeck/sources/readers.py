"""Readers of observation text files, grids, moorings and region layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinedeck.fixed_values import CAST_DENY_LIST, CAST_PREAMBLE_LINES, NULL_TOKENS, PROJECT, STATION_NAMES
from brinedeck.functions.missing import map_code, matches, not_in
from brinedeck.functions.text import cast_code, station_of_cast, time_of_day
from brinedeck.functions.timefn import from_days_since, local_from_utc, utc_from_local
from brinedeck.operators.geo import lookup_tz, polygon_edges
from brinedeck.operators.quality import qc_keep, qc_mask, replicate_mean
from brinedeck.sources import schemas


def read_obs_csv(
    spark: SparkSession, path: str, table: Mapping[str, tuple[str, str]],
    null_tokens: Iterable[str] = NULL_TOKENS, preamble: int = 0, width: int = 64,
) -> DataFrame:
    """Columns of ``table`` from CSV files with a header line, after ``preamble`` lines that are left out.

    Fields are found by the header of their own file, so files may order their
    columns differently or lack some.  They are read as text, null tokens
    become NULL, and the rest is cast, so no pass over the data infers types.
    Lines are cut by Spark's CSV parser: a quote inside a field that does not begin
    with one is text.  Records end with their line.  A header of more than
    ``width`` columns is an error.
    """
    names = F.transform(_cells(F.col("header"), width + 1), lambda c: F.lower(F.trim(c)))
    names = F.when(F.get(names, F.lit(width)).isNotNull(), F.raise_error(F.lit(f"a header has more than {width} columns"))).otherwise(names)
    places = F.struct(*[F.array_position(names, F.lit(source.lower())).cast("int").alias(f"_{k}") for k, (source, _) in enumerate(table.values())])
    cut = _lines_with_header(spark, path, preamble, places).select(_cells(F.col("value"), width).alias("_fields"), "_places")
    tokens = list(null_tokens)
    out = []
    for k, (name, (_, kind)) in enumerate(table.items()):
        at = F.col(f"_places._{k}")
        text = F.when(at > 0, F.get("_fields", at - 1))
        text = F.when((text != "") & ~text.isin(tokens), text)
        out.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return cut.select(*out)


def _lines_with_header(spark: SparkSession, path: str, preamble: int, places: Column) -> DataFrame:
    """Data lines with ``places``, worked out once from the header line of their file.

    Lines are numbered as they are read.  The first number of a file's first
    block gives each line its place, and the header is the line at place
    ``preamble``: one row per file that meets the file's lines, without a job per file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_top"),
    ).withColumn("_n", F.monotonically_increasing_id())
    top = lines.filter("_top")
    starts = top.groupBy("_file").agg(F.min("_n").alias("_first"))
    heads = top.join(starts, "_file").filter(F.col("_n") == F.col("_first") + preamble).select("_file", F.col("value").alias("header"), F.col("_n").alias("_head"))
    heads = heads.select("_file", "_head", places.alias("_places"))
    body = lines.join(heads, "_file").filter(~F.col("_top") | (F.col("_n") > F.col("_head")))
    return body.filter(F.trim("value") != "").select("value", "_places")


def _cells(line: Column, width: int) -> Column:
    """The first ``width`` fields of a CSV line; doubled quotes in a quoted field stand for one. The line is parsed once, not once a field."""
    names = [f"_{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return F.get(F.transform(F.array(parsed), lambda s: F.array(*[s[n] for n in names])), F.lit(0))


def load_stations(spark: SparkSession, path: str, project: str = PROJECT) -> DataFrame:
    return read_obs_csv(spark, path, schemas.STATION).filter(F.col("ProjectName") == project)


def load_trips(spark: SparkSession, path: str, project: str = PROJECT) -> DataFrame:
    """Trips of a project with date parts and UTC time; the zone comes from the station code."""
    trips = read_obs_csv(spark, path, schemas.TRIP).filter(F.col("ProjectName") == project)
    local = F.col("SampleDateLocal")
    return trips.select(
        "TripCode", "Station", "StationCode", "Latitude", "Longitude", "SampleDateLocal",
        F.year(local).alias("Year"), F.month(local).alias("Month"), F.dayofmonth(local).alias("Day"),
        time_of_day(local).alias("Time_24hr"),
        utc_from_local(local, lookup_tz(F.col("StationCode"))).alias("SampleDateUTC"),
        "Biomass_mgm3", "Secchi_m", "SampleType",
    )


def load_phyto(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.PHYTO)


def load_zoo(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.ZOO)


def load_zoo_count(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.ZOO_COUNT)


def load_change_log(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.CHANGE_LOG)


def load_taxon_info(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.TAXON_INFO)


def load_chemistry(spark: SparkSession, path: str, sums: tuple[str, ...] = ()) -> DataFrame:
    """Chemistry per trip and depth: bad values masked, replicates averaged.

    Name a measure in ``sums`` to add its replicates up instead.
    """
    masked = qc_mask(read_obs_csv(spark, path, schemas.CHEMISTRY), schemas.CHEMISTRY_FLAGS)
    means = [m for m in schemas.CHEMISTRY_FLAGS if m not in sums]
    return replicate_mean(masked, ["TripCode", "SampleDepth_m"], means, sums)


def load_pico_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.PICO)


def load_pico(spark: SparkSession, path: str) -> DataFrame:
    masked = qc_mask(load_pico_raw(spark, path), schemas.PICO_FLAGS)
    return replicate_mean(masked, ["TripCode", "SampleDepth_m"], list(schemas.PICO_FLAGS))


def load_pigments(spark: SparkSession, path: str, flagged: bool = True) -> DataFrame:
    """Pigments; ``flagged`` keeps the rows with a good flag only."""
    rows = read_obs_csv(spark, path, schemas.PIGMENTS).withColumn("Chla", F.col(schemas.CHLOROPHYLL))
    return (qc_keep(rows, "PIGMENTS_FLAG") if flagged else rows).drop("PIGMENTS_FLAG")


def load_tss(spark: SparkSession, path: str) -> DataFrame:
    """Suspended solids per trip and depth; the station prefix is cut off the trip code."""
    rows = read_obs_csv(spark, path, schemas.TSS).withColumn("TripCode", F.substr("TripCode", F.lit(4)))
    masked = qc_mask(rows, {m: "TSSFLAG" for m in schemas.TSS_MEASURES})
    return replicate_mean(masked, ["TripCode", "SampleDepth_m"], schemas.TSS_MEASURES).dropna(subset=["SampleDepth_m"])


def load_ctd(spark: SparkSession, path: str, preamble: int = CAST_PREAMBLE_LINES) -> DataFrame:
    """Cast rows of the project's sites, with station name, cast code and local time."""
    rows = read_obs_csv(spark, path, schemas.CTD, preamble=preamble)
    rows = rows.filter(matches(F.col("site_code"), PROJECT) & not_in(F.col("file_id"), CAST_DENY_LIST))
    return rows.withColumns({
        "StationName": map_code(station_of_cast(F.col("site_code")), STATION_NAMES),
        "TripCode": cast_code(F.col("site_code"), F.col("CastTime_UTC")),
        "Chla_mgm3": F.coalesce("Chla_mgm3", "Fluorescence_mgm3"),
        "castTime_Local": local_from_utc(F.col("CastTime_UTC").cast("timestamp"), "Australia/Perth"),
    }).drop("Fluorescence_mgm3")


def load_tow_samples(spark: SparkSession, path: str, kind: str = "all") -> DataFrame:
    """Towed-recorder samples: all of a known type, or the ``P`` or ``Z`` ones."""
    rows = read_obs_csv(spark, path, schemas.TOW_SAMPLE)
    if kind == "all":
        rows = rows.filter(F.col("SampleType").isNotNull())
    else:
        rows = rows.filter(matches(F.col("SampleType"), kind))
    utc = F.col("SampleDateUTC")
    return rows.select(
        "TripCode", "Sample", "Latitude", "Longitude", "SampleDateUTC",
        F.year(utc).alias("Year"), F.month(utc).alias("Month"), F.dayofmonth(utc).alias("Day"),
        time_of_day(utc).alias("Time_24hr"), "Region", "Route", "PCI", "Biomass_mgm3",
    )


def load_tow_phyto(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.TOW_PHYTO)


def load_tow_zoo(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.TOW_ZOO)


def load_tow_zoo_count(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.TOW_ZOO_COUNT)


def load_tow_props(spark: SparkSession, path: str) -> DataFrame:
    return read_obs_csv(spark, path, schemas.TOW_PROPS)


def read_grid(spark: SparkSession, path: str, product: str | None = None) -> DataFrame:
    """Long grid table; with partitions by product and period only the asked layers are read."""
    grid = spark.read.parquet(path)
    return grid if product is None else grid.filter(F.col("product") == product)


def read_mooring(spark: SparkSession, path: str, epoch: str) -> DataFrame:
    """Mooring vectors with days since ``epoch`` turned into a timestamp."""
    rows = spark.read.parquet(path)
    return rows.withColumn("time", from_days_since(F.col("time").cast("double"), epoch))


def load_regions(spark: SparkSession, path: str, region: list[str]) -> DataFrame:
    """Edges of a polygon layer stored as (attributes, ring, seq, x, y) rows."""
    return polygon_edges(spark.read.parquet(path), region)
