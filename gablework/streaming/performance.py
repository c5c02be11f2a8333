"""Model performance over predictions and actual values that arrive apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gablework.functions.columns import ratio


def joined_late(
    predictions: DataFrame,
    actuals: DataFrame,
    key: str,
    within: str = "10 days",
    late: str = "30 days",
    predicted_at: str = "predicted_at",
    sold_at: str = "sold_at",
) -> DataFrame:
    """Predictions with the actual value that came up to ``within`` after them.

    Both sides carry a watermark, so the state of the join is bounded: a
    prediction is dropped once no value can be in time any more, a value once
    no prediction it could belong to can still come.  ``key`` must be in both.
    """
    left = predictions.withWatermark(predicted_at, late)
    right = actuals.withColumnRenamed(key, "_key").withWatermark(sold_at, late)
    in_time = (F.col(sold_at) >= F.col(predicted_at)) & (F.col(sold_at) <= F.col(predicted_at) + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(key) == F.col("_key")) & in_time).drop("_key")


def windowed_fit(rows: DataFrame, every: str = "90 days", when: str = "predicted_at", target: str = "price", predicted: str = "predicted") -> DataFrame:
    """Per window of event time: rows, R2 and RMSE, from sums that Spark keeps as its own state."""
    error, value = F.col(target) - F.col(predicted), F.col(target)
    sums = rows.groupBy(F.window(when, every).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("_sse"), F.var_pop(value).alias("_var")
    )
    n = F.col("n").cast("double")
    return sums.select(
        F.col("w.start").alias("window_start"),
        "n",
        (F.lit(1.0) - ratio(F.col("_sse"), n * F.col("_var"))).alias("r2"),
        F.sqrt(F.col("_sse") / n).alias("rmse"),
    )
