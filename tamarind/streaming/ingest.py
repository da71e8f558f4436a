"""Incremental loads as Structured Streaming: each landed file once, each key once, late rows by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_records(spark: SparkSession, path: str, schema: str, key: str, at: str, lateness: str = "7 days", stamp: str | None = None) -> DataFrame:
    """A stream of the Parquet files that land below ``path``; a key seen within ``lateness`` of event time is not given again.

    ``stamp`` names a column without a zone that is read as UTC into ``at``.
    """
    stream = spark.readStream.schema(schema).parquet(path)
    if stamp:
        stream = stream.withColumn(at, F.col(stamp).cast("timestamp"))
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Load everything that has landed since the last call into ``target`` and stop."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(stream: DataFrame, at: str, width: str, by: str, lateness: str = "1 hour") -> DataFrame:
    """Rows by window of event time and ``by``."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def final_counts(counts: DataFrame, folder: str) -> DataFrame:
    """The counts of a stream once it has taken all that has landed: its last update of every group, kept as files in ``folder``."""
    spark = counts.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/updates/batch={number}")

    query = counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    keys = [c for c in counts.columns if c != "n"]
    updates = spark.read.parquet(f"{folder}/updates")
    return updates.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))
