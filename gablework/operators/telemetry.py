"""Serving telemetry: canary, A/B, alerts and rates.

The functions take a frame of requests (``ts, variant, response_time,
is_error``); those made of groupings and filters only work on a stream too.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import num, ratio, tally
from gablework.functions.stats import chi_square_1df_p, chi_square_2x2, pooled_t
from gablework.roles import (
    AB_MIN_SAMPLES,
    ALERT_LIMITS,
    BATCH_SIZE_LIMIT,
    CANARY_ERROR,
    CANARY_SUCCESS,
    REQUESTS_PER_MINUTE,
)


def _errors() -> Column:
    return F.sum(F.col("is_error").cast("bigint"))


def rates() -> list[Column]:
    """Request count, success and error rate as aggregates, 0 without requests."""
    total = F.count(F.lit(1))
    return [
        total.alias("requests"),
        _errors().alias("errors"),
        F.coalesce(ratio(total - _errors(), total), num(0)).alias("success_rate"),
        F.coalesce(ratio(_errors(), total), num(0)).alias("error_rate"),
    ]


def rates_by(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(*rates())


def windowed_rates(df: DataFrame, every: str = "30 seconds", by: str = "variant") -> DataFrame:
    """Rates per tumbling window and variant; ``window`` becomes two columns."""
    grouped = df.groupBy(F.window("ts", every).alias("w"), by).agg(*rates())
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        by,
        "requests",
        "errors",
        "success_rate",
        "error_rate",
    )


def first_abort(windows: DataFrame, limit: float = CANARY_ERROR, variant: str = "canary") -> DataFrame:
    """The first canary window whose error rate exceeds the limit, if any."""
    bad = windows.where((F.col("variant") == variant) & (F.col("error_rate") > limit))
    return bad.agg(F.min("window_start").alias("abort_at"), F.count(F.lit(1)).alias("bad_windows"))


def canary_decision(
    windows: DataFrame, success: float = CANARY_SUCCESS, error: float = CANARY_ERROR, variant: str = "canary"
) -> DataFrame:
    """Promote or roll back by the plain mean of the window rates."""
    means = windows.where(F.col("variant") == variant).agg(
        F.avg("success_rate").alias("mean_success"),
        F.avg("error_rate").alias("mean_error"),
        F.count(F.lit(1)).alias("windows"),
    )
    good = (F.col("mean_success") >= success) & (F.col("mean_error") <= error)
    return means.withColumn("decision", F.when(good, "promote").otherwise("rollback"))


# --- A/B -------------------------------------------------------------------


def arm_statistics(df: DataFrame, arm: str = "arm") -> DataFrame:
    """Sufficient statistics of both arms in one row."""
    stats = []
    for name in ("A", "B"):
        here = F.col(arm) == name
        value = F.when(here, F.col("response_time"))
        stats += [
            tally(here).alias(f"samples_{name.lower()}"),
            F.avg(value).alias(f"mean_{name.lower()}"),
            F.stddev_samp(value).alias(f"std_{name.lower()}"),
            F.coalesce(F.sum(F.when(here, F.col("is_error").cast("bigint"))), F.lit(0)).alias(
                f"errors_{name.lower()}"
            ),
        ]
    return df.agg(*stats)


def sample_guard(stats: DataFrame, minimum: int = AB_MIN_SAMPLES) -> DataFrame:
    enough = (F.col("samples_a") >= minimum) & (F.col("samples_b") >= minimum)
    return stats.select(
        "samples_a",
        "samples_b",
        F.lit(minimum).alias("minimum_required"),
        F.when(enough, "ok").otherwise("insufficient").alias("status"),
    )


def ab_comparison(stats: DataFrame) -> DataFrame:
    """Pooled t of the response times, error rates and their chi-square."""
    c = F.col
    n1, n2 = c("samples_a").cast("double"), c("samples_b").cast("double")
    return stats.select(
        "samples_a",
        "samples_b",
        "mean_a",
        "mean_b",
        pooled_t(n1, c("mean_a"), c("std_a"), n2, c("mean_b"), c("std_b")).alias("t_statistic"),
        ratio(c("errors_a"), c("samples_a")).alias("error_rate_a"),
        ratio(c("errors_b"), c("samples_b")).alias("error_rate_b"),
        chi_square_2x2(
            c("errors_a"), c("samples_a") - c("errors_a"), c("errors_b"), c("samples_b") - c("errors_b")
        ).alias("chi_square"),
    ).withColumn("error_p_value", chi_square_1df_p(F.col("chi_square")))


def t_test_p(df: DataFrame, arm: str = "arm") -> DataFrame:
    """Two-sided p of the pooled t-test: with two groups it is that of the F test.

    ``ANOVATest`` has no Python class, so its public JVM entry is called; the
    work is one distributed aggregation.
    """
    spark = df.sparkSession
    prepared = VectorAssembler(inputCols=["response_time"], outputCol="features", handleInvalid="skip").transform(
        df.select("response_time", F.when(F.col(arm) == "A", 0.0).otherwise(1.0).alias("label"))
    )
    test = spark._jvm.org.apache.spark.ml.stat.ANOVATest
    result = DataFrame(test.test(prepared._jdf, "features", "label", True), spark)
    return result.select(F.col("pValue").alias("p_value"), F.col("fValue").alias("f_value"))


def ab_decision(df: DataFrame, alpha: float = 0.05, minimum: int = AB_MIN_SAMPLES, arm: str = "arm") -> DataFrame:
    """Winner by lower mean response time if the test is significant.

    Too few samples or no significance leave the test inconclusive and arm A
    in production.
    """
    p = t_test_p(df, arm).select("p_value").scalar()
    compared = ab_comparison(arm_statistics(df, arm)).withColumn("p_value", p)
    enough = (F.col("samples_a") >= minimum) & (F.col("samples_b") >= minimum)
    significant = enough & F.coalesce(F.col("p_value") < alpha, F.lit(False))
    better = F.when(F.col("mean_a") < F.col("mean_b"), "A").otherwise("B")
    return compared.select(
        "*",
        significant.alias("significant"),
        F.when(significant, better).otherwise("inconclusive").alias("winner"),
        F.when(significant, better).otherwise("A").alias("deployed"),
    )


def error_independence(df: DataFrame, arm: str = "arm") -> DataFrame:
    """Chi-square test of error against arm."""
    rows = VectorAssembler(inputCols=["is_error"], outputCol="features").transform(
        df.select("is_error", F.when(F.col(arm) == "A", 0.0).otherwise(1.0).alias("label"))
    )
    return ChiSquareTest.test(rows, "features", "label", True).select(
        F.col("statistic").alias("chi_square"), F.col("pValue").alias("p_value")
    )


# --- alerts and rates ------------------------------------------------------


def alerts(
    df: DataFrame,
    every: str = "1 hour",
    limits: dict[str, float] = ALERT_LIMITS,
    latency_scale: float = 1.0,
) -> DataFrame:
    """Windows whose mean latency, error rate or gauges exceed their limits.

    Gauges (cpu, memory, disk) are judged where the frame has such columns.
    """
    measured = {"response_time_ms": F.avg(F.col("response_time") * latency_scale), "error_rate": F.avg("is_error")}
    for name in limits:
        if name in df.columns:
            measured[name] = F.avg(name)
    used = [name for name in limits if name in measured]
    grouped = df.groupBy(F.window("ts", every).alias("w")).agg(*[measured[n].alias(n) for n in used])
    rows = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"), num(limits[n]).alias("limit"))
        for n in used
    ]
    long = grouped.select(F.col("w.start").alias("window_start"), F.inline(F.array(*rows)))
    return long.where(F.col("value") > F.col("limit"))


def rate_violations(df: DataFrame, client: str = "user_id", limit: int = REQUESTS_PER_MINUTE, every: str = "60 seconds") -> DataFrame:
    """Clients with more requests in a window than allowed."""
    counts = df.groupBy(F.window("ts", every).alias("w"), client).agg(F.count(F.lit(1)).alias("requests"))
    return counts.where(F.col("requests") > limit).select(
        F.col("w.start").alias("window_start"), client, "requests"
    )


def request_rate(df: DataFrame, every: str = "1 minute", seconds: int = 60, target: float = 100.0) -> DataFrame:
    """Requests per second and window, and their share of the target."""
    counts = df.groupBy(F.window("ts", every).alias("w")).agg(F.count(F.lit(1)).alias("requests"))
    rate = F.col("requests") / num(seconds)
    return counts.select(
        F.col("w.start").alias("window_start"),
        "requests",
        rate.alias("requests_per_second"),
        (rate / num(target)).alias("target_share"),
    )


def batch_envelope(scored: DataFrame, batch: str, limit: int = BATCH_SIZE_LIMIT) -> DataFrame:
    """Size of each scored batch and whether it keeps the limit."""
    return scored.groupBy(batch).agg(F.count(F.lit(1)).alias("batch_size")).withColumn(
        "within_limit", F.col("batch_size") <= limit
    )
