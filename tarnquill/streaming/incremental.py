"""Incremental batches: new files of a folder update additive counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def keyword_counts_available_now(spark: SparkSession, source: str, out: str, progress: str) -> StreamingQuery:
    """Counts of every file of ``source`` not seen before, one folder of partial counts per batch under ``out``.

    A batch that is run again overwrites its own folder, so counts stay exact; ``progress`` is the stream's checkpoint.
    """
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        counts = batch.where("trim(keyword_id) <> ''").groupBy("keyword_id").agg(F.count("*").alias("n_rows"))
        counts.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()


def merged_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts of all batches so far."""
    return spark.read.parquet(out).groupBy("keyword_id").agg(F.sum("n_rows").alias("n_rows"))
