"""Scores, gates and reports over one-row metric frames.

Input frames hold one row of finished metrics; everything here is column
arithmetic on that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import num, ratio
from gablework.roles import GRADES, LOWEST_GRADE, ROBUSTNESS_THRESHOLD

# Threshold name -> (metric, whether more is better, value of a missing metric).
THRESHOLD_METRICS = {
    "min_r2": ("r2", True, 0.0),
    "max_rmse": ("rmse", False, float("inf")),
    "max_mae": ("mae", False, float("inf")),
    "max_mape": ("mape", False, float("inf")),
}


def check_thresholds(metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """One row per threshold given: metric value, limit, passed."""
    rows = []
    for name, limit in thresholds.items():
        metric, at_least, missing = THRESHOLD_METRICS[name]
        value = F.coalesce(F.col(metric), num(missing)) if metric in metrics.columns else num(missing)
        passed = value >= num(limit) if at_least else value <= num(limit)
        rows.append(
            F.struct(
                F.lit(name).alias("threshold"),
                value.cast("double").alias("value"),
                num(limit).alias("limit"),
                passed.alias("passed"),
            )
        )
    if not rows:
        return metrics.sparkSession.createDataFrame(
            [], "threshold string, value double, limit double, passed boolean"
        )
    return metrics.select(F.inline(F.array(*rows)))


def meets_thresholds(metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Whether every threshold given is met; none given passes."""
    checked = check_thresholds(metrics, thresholds)
    return checked.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))


# --- scores and approval ---------------------------------------------------


def validation_score(max_rmse: float, max_mape: float) -> Column:
    return (
        F.col("r2") * 0.4
        + (1.0 - F.least(F.col("rmse") / num(max_rmse), num(1))) * 0.3
        + (1.0 - F.least(F.col("mape") / num(max_mape), num(1))) * 0.3
    )


def business_score() -> Column:
    return F.col("pass_rate") * 0.5 + (1.0 - F.col("extreme_error_rate")) * 0.5


def overall_score() -> Column:
    return F.col("validation_score") * 0.5 + F.col("robustness_score") * 0.3 + F.col("business_score") * 0.2


def grade(score: Column) -> Column:
    label = None
    for name, limit in GRADES:
        label = F.when(score >= limit, name) if label is None else label.when(score >= limit, name)
    return label.otherwise(LOWEST_GRADE)


def approve(metrics: DataFrame, min_r2: float, max_rmse: float, max_mape: float) -> DataFrame:
    """Scores, grade, approval and the reasons against it.

    Needs r2, rmse, mape, pass_rate, extreme_error_rate and robustness_score.
    """
    scored = (
        metrics.withColumn("validation_score", validation_score(max_rmse, max_mape))
        .withColumn("business_score", business_score())
        .withColumn("overall_score", overall_score())
    )
    r2_ok = F.col("r2") >= min_r2
    rmse_ok = F.col("rmse") <= max_rmse
    mape_ok = F.col("mape") <= max_mape
    robust = F.col("robustness_score") >= ROBUSTNESS_THRESHOLD
    reasons = F.array_compact(
        F.array(
            F.when(~r2_ok, F.format_string(f"R2 %.4f below minimum {min_r2}", F.col("r2"))),
            F.when(~rmse_ok, F.format_string(f"RMSE %,.0f above maximum {max_rmse:,.0f}", F.col("rmse"))),
            F.when(~mape_ok, F.format_string(f"MAPE %.1f%% above maximum {max_mape}%%", F.col("mape"))),
            F.when(
                ~robust,
                F.format_string(
                    f"robustness score %.3f below threshold {ROBUSTNESS_THRESHOLD}", F.col("robustness_score")
                ),
            ),
        )
    )
    return scored.select(
        "*",
        grade(F.col("overall_score")).alias("grade"),
        (r2_ok & rmse_ok & mape_ok & robust).alias("approved"),
        (F.col("business_score") >= 0.8).alias("business_criteria_met"),
        F.array_join(reasons, "; ").alias("reasons"),
    )


def readiness(metrics: DataFrame) -> DataFrame:
    """Four criteria, their share in percent, approval from 75.

    Needs coverage, within_20_percent, r2 and stability.
    """
    flags = {
        "coverage_ok": F.col("coverage") >= 95,
        "accuracy_ok": F.col("within_20_percent") >= 70,
        "r2_ok": F.col("r2") >= 0.7,
        "stability_ok": F.col("stability") < 1.0,
    }
    passed = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags.values()), F.lit(0))
    return metrics.select(
        "*",
        *[f.alias(name) for name, f in flags.items()],
        passed.alias("criteria_passed"),
        (passed * 100.0 / len(flags)).alias("readiness_percent"),
    ).withColumn("ready", F.col("readiness_percent") >= 75)


def certificate(metrics: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    """Quality certificate of a ready model with its expiry date.

    Needs readiness columns, r2, rmse, coverage, within_20_percent and max_drop.
    The month arithmetic clamps to the end of the month.
    """
    day = F.to_date(F.lit(as_of))
    criteria = F.array(
        F.format_string("R2 %.4f >= 0.70", F.col("r2")),
        F.format_string("coverage %.1f%% >= 95%%", F.col("coverage")),
        F.format_string("accuracy %.1f%% >= 70%%", F.col("within_20_percent")),
        F.format_string("noise drop %.1f%% <= 20%%", F.col("max_drop")),
    )
    return metrics.where("ready").select(
        F.concat(F.lit("model_"), F.date_format(day, "yyyyMMdd")).alias("model_id"),
        F.date_format(day, "yyyy-MM-dd").alias("certified_on"),
        F.date_format(F.add_months(day, months), "yyyy-MM-dd").alias("expires_on"),
        F.lit("APPROVED").alias("status"),
        F.col("readiness_percent").alias("quality_score"),
        F.array_join(criteria, "; ").alias("criteria"),
    )


def noise_label() -> Column:
    return (
        F.when(F.col("max_drop") < 5, "very robust")
        .when(F.col("max_drop") < 10, "robust")
        .when(F.col("max_drop") < 20, "moderately robust")
        .otherwise("fragile")
    )


def noise_tolerance() -> Column:
    return F.when(F.col("max_drop") < 10, "Good").when(F.col("max_drop") < 20, "Moderate").otherwise("Poor")


def monitoring_report(metrics: DataFrame) -> DataFrame:
    """Noise tolerance, health flags and recommendations.

    Needs r2, max_drop, within_20_percent, weak_scenarios (a joined list, may
    be empty).
    """
    weak = F.col("weak_scenarios") != ""
    advice = F.array_compact(
        F.array(
            F.when(F.col("r2") < 0.8, F.lit("collect more features to raise accuracy")),
            F.when(F.col("max_drop") > 15, F.lit("validate inputs strictly in production")),
            F.when(F.col("within_20_percent") < 80, F.lit("alert on predictions of high uncertainty")),
            F.when(weak, F.concat(F.lit("watch these scenarios: "), F.col("weak_scenarios"))),
        )
    )
    default = F.array(F.lit("model is sound; keep standard monitoring"))
    return metrics.select(
        "*",
        (F.col("r2") < 0.8).alias("needs_features"),
        (F.col("max_drop") > 15).alias("needs_input_checks"),
        (F.col("within_20_percent") < 80).alias("needs_alerts"),
        noise_tolerance().alias("noise_tolerance"),
        F.array_join(F.when(F.size(advice) > 0, advice).otherwise(default), "; ").alias("recommendations"),
    )


# --- comparing models ------------------------------------------------------


def compare_models(two: DataFrame) -> DataFrame:
    """The better of two models by R2 (a tie goes to the second) and its gain.

    Needs r2_1, rmse_1, r2_2 and rmse_2.
    """
    first = F.col("r2_1") > F.col("r2_2")
    gain = F.when(first, ratio(F.col("r2_1") - F.col("r2_2"), F.col("r2_2"))).otherwise(
        ratio(F.col("r2_2") - F.col("r2_1"), F.col("r2_1"))
    )
    return two.select(
        "*",
        F.when(first, "model1").otherwise("model2").alias("better_model"),
        (gain * 100.0).alias("improvement_percent"),
    )


def improvement(two: DataFrame) -> DataFrame:
    """Percent gained by the tuned model over the baseline, per metric.

    Needs rmse, mae and r2 with suffixes ``_base`` and ``_tuned``.
    """
    rows = []
    for metric, falling in (("rmse", True), ("mae", True), ("r2", False)):
        base, tuned = F.col(f"{metric}_base"), F.col(f"{metric}_tuned")
        change = base - tuned if falling else tuned - base
        rows.append(F.struct(F.lit(metric).alias("metric"), (ratio(change, base) * 100.0).alias("percent")))
    return two.select(F.inline(F.array(*rows))).withColumn(
        "direction", F.when(F.col("percent") > 0, "better").otherwise("worse")
    )


def champion(candidates: DataFrame, metric: str = "r2", name: str = "model", default: str = "baseline") -> DataFrame:
    """The candidate with the highest metric; the default model wins ties."""
    order = [F.col(metric).desc_nulls_last(), (F.col(name) != default).asc(), F.col(name)]
    return candidates.orderBy(*order).limit(1)


def overfit_flag(validation_r2: Column, test_r2: Column, slack: float = 0.05) -> Column:
    return test_r2 < validation_r2 - slack


def metric_table(by_split: DataFrame, split: str = "split") -> DataFrame:
    """Metrics as rows, splits as columns."""
    long = by_split.select(
        split,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                    for m in ("rmse", "mae", "r2", "mape")
                ]
            )
        ),
    )
    return long.groupBy("metric").pivot(split, ["validation", "test"]).agg(F.max("value"))
