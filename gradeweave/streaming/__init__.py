"""Programme rows as they arrive: late rows, first rows, counts per window. An extension beside the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_programmes(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_seen(stream: DataFrame, late: str = "48 hours") -> DataFrame:
    """Each (source, channel_id, start) once, however often it is loaded within the watermark."""
    return stream.filter("loaded_at IS NOT NULL").withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(["source", "channel_id", "start"])


def window_counts(stream: DataFrame, width: str = "6 hours", late: str = "48 hours") -> DataFrame:
    """source, window, n_rows, n_channels of rows by the time they were loaded; windows close when the watermark passes."""
    return (
        stream.filter("loaded_at IS NOT NULL").withWatermark("loaded_at", late).groupBy("source", F.window("loaded_at", width).alias("w"))
        .agg(F.count("*").alias("n_rows"), F.approx_count_distinct("channel_id").alias("n_channels"))
        .select("source", F.unix_seconds("w.start").alias("window_s"), "n_rows", "n_channels")
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, then stop; the checkpoint makes the next run go on from here."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
