"""Product sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_product(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a product as a folder of files; executors write their own partitions.

    CSV export has a header and prints timestamps to the second.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def newest_first(df: DataFrame, date: str) -> DataFrame:
    """Export order of the matrices; a range sort, for use right before a write."""
    return df.orderBy(F.col(date).desc())


def write_grid(df: DataFrame, path: str, by: Sequence[str] = ("product", "period")) -> None:
    """Long grid by product and period, cells of a layer in index order for tight row-group statistics.

    Range partitioning splits a layer that is much larger than the others.
    """
    order = [*by, "lat_idx", "lon_idx"]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*by).parquet(path)


MANIFEST = "name string, fmt string, folder string, edition long"


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/_manifest")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def publish_set(products: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> int:
    """Write a set of products beside the set now published, then publish it; returns its edition.

    Each product goes to a folder of its own.  The edition appears when one file of manifest rows is added,
    after the last product is whole, so a failed write leaves the earlier set as it was, and a product
    may be derived from the earlier edition of itself.  Older editions stay until their folders are
    removed.  One writer publishes at a time.  An empty set is refused.
    """
    if not products:
        raise ValueError("nothing to publish")
    spark = next(iter(products.values())).sparkSession
    run, rows = uuid.uuid4().hex, []
    for name, df in products.items():
        folder = f"{name}/{run}"
        write_product(df, f"{root.rstrip('/')}/{folder}", fmt)
        rows.append((name, fmt, folder))
    earlier = _manifest(spark, root)
    edition = 1 if earlier is None else earlier.agg(F.coalesce(F.max("edition"), F.lit(0)) + 1).first()[0]
    listed = spark.createDataFrame([(*r, edition) for r in rows], MANIFEST)
    listed.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/_manifest")
    return edition


def read_published(spark: SparkSession, root: str, name: str, edition: int | None = None) -> DataFrame:
    """A product of the newest published set, or of ``edition``; CSV columns are text."""
    rows = _manifest(spark, root)
    if rows is None:
        raise LookupError(f"nothing is published in {root}")
    wanted = rows.agg(F.max("edition")).first()[0] if edition is None else edition
    found = rows.filter((F.col("edition") == wanted) & (F.col("name") == name)).first()
    if found is None:
        raise LookupError(f"edition {wanted} has no product {name!r}")
    reader = spark.read.option("header", True) if found["fmt"] == "csv" else spark.read
    return reader.format(found["fmt"]).load(f"{root.rstrip('/')}/{found['folder']}")
