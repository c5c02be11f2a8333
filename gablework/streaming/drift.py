"""Continuous drift monitoring: each batch of new rows against the reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from gablework.operators.drift import ks_drift, ks_from_sketches, mark_samples, sketches
from gablework.session import written


def start_drift_monitor(
    reference: DataFrame,
    incoming: DataFrame,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    every: str | None = "1 hour",
) -> StreamingQuery:
    """Test every batch and write one row per column and batch.

    ``every=None`` works off what is there and stops.  A batch run again
    replaces its own folder.
    """

    def test(batch: DataFrame, number: int) -> None:
        tested = ks_drift(mark_samples(reference, batch, columns), columns)
        tested.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(
            f"{path}/batch_id={number}"
        )

    writer = incoming.writeStream.foreachBatch(test).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def start_sketch_monitor(
    reference: DataFrame,
    incoming: DataFrame,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    every: str | None = "1 hour",
    alpha: float = 0.05,
) -> StreamingQuery:
    """Test all rows that came so far against the reference, batch by batch, from sketches.

    The reference is read once, when the monitor first starts: its sketches are
    written below ``path`` and found there after a restart.  A batch is read once,
    and its sketches are merged into those of the batch before.  Rows of the result:
    one per column and batch, with a bound on the error of the statistic.  A
    batch run again replaces its own folders.
    """
    spark = reference.sparkSession
    if not written(spark, f"{path}/reference"):
        sketches(reference, columns).write.mode("overwrite").parquet(f"{path}/reference")

    def test(batch: DataFrame, number: int) -> None:
        found = sketches(batch, columns)
        if number > 0:
            before = spark.read.parquet(f"{path}/state/batch_id={number - 1}")
            # One row per column on either side.
            found = (
                found.join(F.broadcast(before.withColumnRenamed("sketch", "_before")), "column")
                .withColumn("sketch", F.kll_sketch_merge_double("sketch", "_before"))
                .drop("_before")
            )
        found.write.mode("overwrite").parquet(f"{path}/state/batch_id={number}")
        merged = spark.read.parquet(f"{path}/state/batch_id={number}")
        tested = ks_from_sketches(spark.read.parquet(f"{path}/reference"), merged, alpha)
        tested.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{path}/tests/batch_id={number}")

    writer = incoming.writeStream.foreachBatch(test).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
