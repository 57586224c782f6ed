"""What the operators of this subpackage share: words, written tables, global order, shipping.

Nothing here is Python per row; the functions build plans.
"""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word rule, and its complement, as Java patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one partition are numbered in the lower bits of monotonically_increasing_id().
ROW_BITS = 33


def ship(module: str) -> None:
    """Send the functions of a module to Python workers by value, so that workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps between its tasks; ``make`` builds it when there is none."""
    kept = sys.__dict__.setdefault("_brinedeck_worker_cache", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once and not again at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``); a temporary one if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="brinedeck-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/brinedeck/{uuid.uuid4().hex}"


def settle(df: DataFrame, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan ends there, and lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, keys: Sequence[Column | str], dealt_by: Sequence[Column | str] | None = None, codec: str | None = None) -> DataFrame:
    """``df`` settled in the global order of ``keys``, with ``_part`` (range partition) and ``_row`` (place in all rows, from 0).

    Rows are dealt by range, so no task holds more than its share unless more rows agree in
    all keys; the only table that is not dealt has one row per partition. ``dealt_by`` deals by
    shorter keys of the same order: a sample of them goes to the driver.
    """
    placed = settle(df.repartitionByRange(*(dealt_by or keys)).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), codec)
    part = F.shiftright("_at", ROW_BITS).cast("int")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn("_row", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop("_at", "_start")


def running_total(ordered: DataFrame, value: str) -> DataFrame:
    """Add ``_before``: the sum of ``value`` over all earlier rows of a table made by ``in_order``."""
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ordered.groupBy("_part").agg(F.sum(value).alias("_sum"))
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    local = ordered.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return local.join(F.broadcast(starts), "_part").withColumn("_before", F.col("_base") + F.col("_inner")).drop("_base", "_inner")
