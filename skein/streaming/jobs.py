"""Job results as a stream: an addition to the batch plans, for results that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.functions.clean import no_nan

SCHEMA = "sample_id string, pgs_id string, SUM double, Z_MostSimilarPop string, Z_norm1 string, Z_norm2 string, percentile_MostSimilarPop string, MostSimilarPop string"


def result_stream(spark: SparkSession, root: str, files_per_batch: int = 100) -> DataFrame:
    """(sample_id, pgs_id, z, seen) of adjusted score files as they come in under root."""
    rows = spark.readStream.schema(SCHEMA).option("sep", "\t").option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(root)
    return rows.select("sample_id", "pgs_id", F.coalesce(no_nan(F.col("Z_norm1").try_cast("double")), F.lit(0.0)).alias("z"), F.current_timestamp().alias("seen"))


def running_moments(results: DataFrame) -> DataFrame:
    """n, mean and deviation of each score so far: state is one row for each score."""
    return results.groupBy("pgs_id").agg(F.count("*").alias("n"), F.avg("z").alias("mean"), F.stddev_pop("z").alias("std"))


def event_counts(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events in windows, late ones dropped after the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def keep_latest(results: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch under its number, so a batch that comes twice replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
