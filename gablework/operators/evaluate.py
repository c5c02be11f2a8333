"""Model evaluation: metrics over actual and predicted values, whole or by segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import fetched, num, ratio, scalar, share, tally
from gablework.functions.metrics import (
    core_metrics,
    explained_variance,
    named,
    percent_error,
    residual,
)
from gablework.functions.stats import normality_p
from gablework.operators.profile import histogram
from gablework.operators.ranking import quantiles
from gablework.roles import AGE_SCENARIOS, PRICE_BANDS, PRICE_CEILING, PRICE_FLOOR

ACTUAL, PREDICTED = "price", "predicted"


def evaluate(df: DataFrame, by: Sequence[str] = (), actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """MSE, RMSE, MAE, R2 and MAPE with the row count, whole or per group."""
    return df.groupBy(*by).agg(F.count(actual).alias("n"), *named(core_metrics(actual, predicted)))


def error_extremes(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Median and largest absolute error, explained variance."""
    median = quantiles(df.select(F.abs(residual(actual, predicted)).alias("error")), ["error"], [0.5])
    middle = fetched(median.select("p50"))["p50"]
    return df.agg(
        F.max(F.abs(residual(actual, predicted))).alias("max_error"),
        explained_variance(actual, predicted).alias("explained_variance"),
    ).select(middle.alias("median_absolute_error"), "max_error", "explained_variance")


def residual_moments(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Mean, deviation, skewness, excess kurtosis and normality p of the residuals."""
    r = residual(actual, predicted)
    moments = df.agg(
        F.count(r).alias("n"),
        F.avg(r).alias("mean"),
        F.stddev_samp(r).alias("std"),
        F.skewness(r).alias("skewness"),
        F.kurtosis(r).alias("kurtosis"),
    )
    return moments.withColumn("normality_p", normality_p(F.col("n"), F.col("skewness"), F.col("kurtosis")))


def sample_statistics(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Half width of the 95% band, mean and deviation of target and prediction."""
    return df.agg(
        F.count(actual).alias("n"),
        (F.stddev_samp(residual(actual, predicted)) * 1.96).alias("half_width_95"),
        F.avg(actual).alias("target_mean"),
        F.stddev_samp(actual).alias("target_std"),
        F.avg(predicted).alias("prediction_mean"),
        F.stddev_pop(predicted).alias("prediction_std"),
    )


# --- segments --------------------------------------------------------------


def price_band(actual: str = ACTUAL) -> Column:
    label = None
    for name, low, high in PRICE_BANDS:
        inside = F.col(actual) >= low
        if high is not None:
            inside = inside & (F.col(actual) < high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


def by_price_band(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    banded = df.withColumn("band", price_band(actual)).where("band is not null")
    return segment_metrics(banded, "band", actual, predicted)


def segment_metrics(df: DataFrame, segment: str, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    metrics = core_metrics(actual, predicted)
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), *named(metrics, "r2", "rmse"))


def quantile_segment(column: str, cuts: Sequence[Column], names: Sequence[str]) -> Column:
    """The first segment whose upper cut the value does not exceed."""
    label = F.when(F.col(column) <= cuts[0], names[0])
    for cut, name in zip(cuts[1:], names[1:]):
        label = label.when(F.col(column) <= cut, name)
    return label.when(F.col(column).isNotNull(), names[len(cuts)])


def by_quartile(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Low (up to Q1), medium (up to Q3) and high targets."""
    q = fetched(quantiles(df, [actual], [0.25, 0.75]).select("p25", "p75"))
    label = quantile_segment(actual, [q["p25"], q["p75"]], ["low_price", "medium_price", "high_price"])
    return segment_metrics(df.withColumn("segment", label), "segment", actual, predicted)


def by_quintile(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Five segments of the target, very low to very high."""
    q = fetched(quantiles(df, [actual], [0.2, 0.4, 0.6, 0.8]).select("p20", "p40", "p60", "p80"))
    names = ["very low", "low", "medium", "high", "very high"]
    label = quantile_segment(actual, [q["p20"], q["p40"], q["p60"], q["p80"]], names)
    return segment_metrics(df.withColumn("segment", label), "segment", actual, predicted)


def by_scenario(
    df: DataFrame, min_rows: int = 5, actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    """Metrics per bedroom count, area class and age class.

    The area classes include both ends, so a boundary row counts in two; each
    row is scored once and then listed under every label it belongs to.
    """
    q = fetched(quantiles(df, ["area"], [0.25, 0.75]).select("p25", "p75"))
    labels = [F.concat(F.col("bedrooms").cast("string"), F.lit("_bedrooms"))]
    labels.append(F.when(F.col("area") <= q["p25"], "area_small"))
    labels.append(F.when(F.col("area").between(q["p25"], q["p75"]), "area_medium"))
    labels.append(F.when(F.col("area") >= q["p75"], "area_large"))
    for name, low, high in AGE_SCENARIOS:
        labels.append(F.when((F.col("age_years") >= low) & (F.col("age_years") < high), f"age_{name}"))
    listed = df.select(actual, predicted, F.explode(F.array_compact(F.array(*labels))).alias("scenario"))
    return segment_metrics(listed, "scenario", actual, predicted).where(F.col("n") >= min_rows)


def weak_scenarios(scenarios: DataFrame, limit: float = 0.6) -> DataFrame:
    return scenarios.where(F.col("r2") < limit)


# --- production metrics ----------------------------------------------------


def in_range(predicted: str = PREDICTED) -> Column:
    return F.col(predicted).between(num(PRICE_FLOOR), num(PRICE_CEILING))


def production_metrics(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Coverage, band, share within 20%, stability: one aggregation."""
    return df.agg(
        (share(in_range(predicted)) * 100.0).alias("coverage"),
        (F.stddev_samp(residual(actual, predicted)) * 1.96).alias("half_width_95"),
        (share(percent_error(actual, predicted) < 20) * 100.0).alias("within_20_percent"),
        ratio(F.stddev_pop(predicted), F.avg(predicted)).alias("stability"),
    )


def error_quantiles(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    errors = df.select(percent_error(actual, predicted).alias("error"))
    return quantiles(errors, ["error"], [0.25, 0.5, 0.75, 0.95]).select("p25", "p50", "p75", "p95")


def confidence_score(actual: str = ACTUAL, predicted: str = PREDICTED) -> Column:
    return 1.0 - ratio(F.abs(residual(actual, predicted)), F.col(actual))


def confidence_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the confidence scores with their overall mean."""
    mean = scalar(df.agg(F.avg(confidence_score()).alias("m")), "m")
    return histogram(df, confidence_score(), bins).withColumn("mean_score", mean)


def residual_outliers(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Rows whose absolute residual exceeds two sample deviations."""
    r = residual(actual, predicted)
    limit = scalar(df.agg((F.stddev_samp(r) * 2.0).alias("t")), "t")
    out = F.abs(r) > limit
    return df.agg(
        F.max(limit).alias("threshold"), tally(out).alias("outliers"), (share(out) * 100.0).alias("percent")
    )


def worst_predictions(df: DataFrame, row_id: str, n: int = 5, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    r = residual(actual, predicted)
    listed = df.select(row_id, actual, predicted, r.alias("residual"), F.abs(r).alias("absolute_residual"))
    return listed.orderBy(F.col("absolute_residual").desc(), row_id).limit(n)


def business_rules(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Range pass rate, errors above 100 percent, variation of the predictions."""
    extreme = ratio(F.abs(residual(actual, predicted)), F.col(actual)) > 1.0
    return df.agg(
        tally(in_range(predicted)).alias("valid_predictions"),
        F.count(F.lit(1)).alias("total_predictions"),
        share(in_range(predicted)).alias("pass_rate"),
        tally(extreme).alias("errors_over_100_percent"),
        share(extreme).alias("extreme_error_rate"),
        ratio(F.stddev_pop(predicted), F.avg(predicted)).alias("variation"),
    ).withColumn("consistent", F.col("variation") < 1.0)


def residual_interval(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Prediction plus and minus 1.96 sample deviations of the residuals."""
    spread = scalar(df.agg((F.stddev_samp(residual(actual, predicted)) * 1.96).alias("h")), "h")
    return df.withColumns({"lower_bound": F.col(predicted) - spread, "upper_bound": F.col(predicted) + spread})
