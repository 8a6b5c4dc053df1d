"""Results as a stream: corrected batches are appended as they come, each batch_index once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def append_results(results: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stream of result records as Parquet: what has been seen is in the checkpoint, so a restart
    appends what is new and nothing twice. Stops when it has read what there is."""
    return results.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def outcome_stream(results: DataFrame, time: str = "done_at", late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Successes and failures in windows of time, results later than `late` left out."""
    from pyspark.sql import functions as F

    ok = F.when(F.col("status") == "success", 1).otherwise(0)
    out = results.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.sum(ok).cast("long").alias("succeeded"), F.sum(1 - ok).cast("long").alias("failed"))
    return out.select("window.start", "window.end", "succeeded", "failed")
