"""Serving telemetry as Structured Streaming.

Every job writes to files in append mode or through ``foreachBatch``; nothing
is gathered in the driver.  State is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gablework.operators.telemetry import rates, windowed_rates
from gablework.sources.logs import audited

LATE = "1 hour"


def read_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """A parquet table as a stream of its files, with the schema it has now.

    The stream source takes a plain path for a folder.  Given as a pattern that
    only matches itself, the path may be a single file as well.
    """
    pattern = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.options(**options).schema(spark.read.parquet(path).schema).parquet(pattern)


def with_event_time(df: DataFrame, column: str = "ts", late: str = LATE) -> DataFrame:
    """Event time as TIMESTAMP (streams refuse the zone-less type) with a watermark."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late)


def run_once(out: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Work off what is there, append it to ``path``, and stop."""
    query = (
        out.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_windowed_rates(requests: DataFrame, every: str = "30 seconds", by: str = "variant") -> DataFrame:
    """Rates per closed window; the same plan as the batch form."""
    return windowed_rates(with_event_time(requests), every, by)


def start_canary_monitor(
    requests: DataFrame, path: str, checkpoint: str, every: str = "30 seconds", trigger: str = "30 seconds"
) -> StreamingQuery:
    """Keep appending closed windows of canary and stable rates."""
    return (
        stream_windowed_rates(requests, every)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )


def arm_sums(df: DataFrame) -> DataFrame:
    """Per arm: count, errors, sum and square sum of the response times."""
    value = F.col("response_time")
    return df.groupBy("arm").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum(F.col("is_error").cast("bigint")).alias("errors"),
        F.sum(value).alias("total"),
        F.sum(value * value).alias("squares"),
    )


def run_ab_accumulation(requests: DataFrame, path: str, checkpoint: str) -> None:
    """Running A/B sums: the state holds two rows, each batch writes both anew.

    Batches go to folders named by their number, so a batch run again after a
    failure replaces its own output only.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(
            f"{path}/batch_id={number}"
        )

    query = (
        arm_sums(requests)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_sums(spark: SparkSession, path: str) -> DataFrame:
    """The sums of the last batch written."""
    written = spark.read.parquet(path).drop("batch_id")
    newest = written.agg(F.max("batch").alias("b")).select("b").scalar()
    return written.where(F.col("batch") == newest).drop("batch")


def run_audit(predictions: DataFrame, path: str, checkpoint: str, row_id: str, rate: float = 0.1) -> None:
    """Append the audit sample of a stream of predictions."""
    run_once(predictions.where(audited(row_id, rate)), path, checkpoint)


def run_error_rates(requests: DataFrame, path: str, checkpoint: str, every: str = "1 hour") -> None:
    """Overall rates per window, appended as windows close."""
    grouped = with_event_time(requests).groupBy(F.window("ts", every).alias("w")).agg(*rates())
    run_once(grouped.select(F.col("w.start").alias("window_start"), "requests", "errors", "error_rate"), path, checkpoint)
