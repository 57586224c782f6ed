"""Session settings the operators are designed for.

No operator sets configuration itself.  They rely on adaptive execution for
two things: turning a join into a broadcast join when the measured side is
under the broadcast threshold, and splitting skewed partitions of the row side
of a join.  Both are on by default in Spark 4; they are named here so that a
cluster profile that turns them off is easy to spot.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "brinedeck", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables written between jobs: ``spark.checkpoint.dir``.

    A session on one machine that names none (tests, small runs) gets a folder of its own; a
    cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brinedeck-"))
    return spark.sparkContext.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan ends there, and lost executors cost no recomputation."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/brinedeck/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
