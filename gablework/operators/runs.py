"""Experiment-run tables: logging, leaderboards, durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gablework.functions.columns import ratio


def metric_rows(wide: DataFrame, run_id: str, metrics: list[str], ts_ms: int, prefix: str = "") -> DataFrame:
    """Long metric rows ``run_id, key, ts_ms, value, step`` from one row per run."""
    rows = [
        F.struct(F.lit(prefix + m).alias("key"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return wide.select(F.col(run_id).cast("string").alias("run_id"), F.inline(F.array(*rows))).select(
        "run_id", "key", F.lit(ts_ms).cast("bigint").alias("ts_ms"), "value", F.lit(0).alias("step")
    )


def importance_rows(importance: DataFrame, run_id: str, ts_ms: int) -> DataFrame:
    return importance.select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit("importance_"), "feature").alias("key"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        F.col("importance").alias("value"),
        F.lit(0).alias("step"),
    )


def with_prefix(metrics: DataFrame, prefix: str) -> DataFrame:
    return metrics.withColumn("key", F.concat(F.lit(prefix), "key"))


def latest(metrics: DataFrame) -> DataFrame:
    """The last value of every metric of every run."""
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", F.struct("step", "ts_ms")).alias("value"))


def leaderboard(metrics: DataFrame, keys: list[str], by: str, falling: bool = True) -> DataFrame:
    """One row per run, the chosen metrics as columns, best run first."""
    wide = latest(metrics).where(F.col("key").isin(*keys)).groupBy("run_id").pivot("key", keys).agg(F.max("value"))
    order = F.col(by).desc_nulls_last() if falling else F.col(by).asc_nulls_last()
    return wide.orderBy(order, "run_id")


def durations(info: DataFrame) -> DataFrame:
    """Seconds per run; failed runs are marked unusable."""
    return info.select(
        "run_id",
        "run_name",
        "status",
        ratio(F.col("end_ms") - F.col("start_ms"), F.lit(1000)).alias("seconds"),
        (F.col("status") == "FINISHED").alias("usable"),
    )
