"""Event streams: counts by windows, kept as an upsert table that a restart resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loamwork.plans.registry import register
from loamwork.session import new_path


def window_counts(events: DataFrame, length: str = "1 hour", late: str = "1 day") -> DataFrame:
    """start, event_type, n, total of events (ts, event_type, value) by tumbling windows; rows later than the watermark are left out, as are rows without a time."""
    on_time = events.filter("ts IS NOT NULL").withWatermark("ts", late)
    counted = on_time.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def run_upserts(stream: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Run a stream over all input there is and return the last row of each key.

    Each batch's changed rows are written to a folder named by the batch, so a batch that
    runs again replaces itself, and a restart goes on from the checkpoint beside them.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    rows = stream.sparkSession.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/rows")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x"))
    return last.select(*keys, *(F.col(f"x.{c}").alias(c) for c in rest))


def read_stream(spark: SparkSession, folder: str, pattern: str, files_each: int = 100) -> DataFrame:
    """New Parquet files of a folder, ``files_each`` in a batch."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_each).parquet(folder)


@register(
    "attempts_by_hour",
    "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
)
def attempts_by_hour(spark, sf_dir):
    """Events by hour and kind, through a stream with a watermark."""
    events = read_stream(spark, sf_dir, "events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    last = run_upserts(window_counts(events), ["start", "event_type"], new_path(spark, "attempts"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
