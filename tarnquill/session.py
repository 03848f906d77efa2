"""Session defaults and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tarnquill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; a cluster's own settings win where they are given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir; a private one, deleted at exit, only in local mode without."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="tarnquill-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def kept_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a table that several plans read, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``kept_folder`` that no plan reads any more."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint into the shared folder.

    checkpoint() writes replicated or shared files, so losing an executor loses nothing, unlike localCheckpoint.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


def numbered(rows: DataFrame, order: str, name: str, first: int = 0) -> DataFrame:
    """Adds the place of each row in the order of a column, from ``first``, without bringing all rows to one task: ranges
    are sorted and counted, and each range is numbered on from those before (their counts, one number per range)."""
    placed = rows.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(2**33 - 1).alias("__place")
    )
    placed = cut_lineage(placed)
    before, offsets = first, []
    for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect():
        offsets.append((r[0], before))
        before += r.n
    counted = rows.sparkSession.createDataFrame(offsets, "__part int, __before bigint")
    return placed.join(F.broadcast(counted), "__part").select(*rows.columns, (F.col("__before") + F.col("__place")).alias(name))
