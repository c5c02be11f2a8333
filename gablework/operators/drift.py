"""Distribution drift between two samples, and what follows from it.

Both samples come in one frame with a boolean column that marks the current
one; two separate frames are joined by :func:`mark_samples`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from gablework.functions.columns import num, ratio, tally, tidy, to_long
from gablework.functions.stats import ks_p
from gablework.operators.ranking import cumulate, value_counts_long

CURRENT = "_current"


def shared_columns(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns both frames have, in the order of the current one."""
    numeric = {n for n, t in reference.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")}
    return [c for c in current.columns if c in numeric and (columns is None or c in columns)]


def mark_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    shared = shared_columns(reference, current, columns)
    old = reference.select(*shared, F.lit(False).alias(CURRENT))
    return old.unionByName(current.select(*shared, F.lit(True).alias(CURRENT)))


def ks_drift(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per column.

    The statistic is exact, the p-value asymptotic.  Distinct values are
    counted per side first and then accumulated range by range, so neither a
    hot value nor a long column ends up in one task.
    """
    counted = value_counts_long(
        df,
        columns,
        counts={"n_ref": tally(~F.col(CURRENT)), "n_cur": tally(F.col(CURRENT))},
    )
    ranked = cumulate(counted, "value", ["n_ref", "n_cur"], ["column"], "column")
    gap = F.abs(ratio(F.col("cum_n_ref"), F.col("total_n_ref")) - ratio(F.col("cum_n_cur"), F.col("total_n_cur")))
    tested = ranked.groupBy("column").agg(
        F.max(gap).alias("ks_statistic"),
        F.max("total_n_ref").alias("reference_rows"),
        F.max("total_n_cur").alias("current_rows"),
        tally(F.col("n_ref") > 0).alias("distinct_reference"),
    )
    p = ks_p(F.col("ks_statistic"), F.col("reference_rows").cast("double"), F.col("current_rows").cast("double"))
    return tested.withColumn("p_value", p).withColumn("drift_detected", F.col("p_value") < alpha)


#: Size of a sketch, and the number of steps between its quantiles that are compared.
SKETCH_K, SKETCH_STEPS = 4096, 1000


def sketch_error(k: int = SKETCH_K, steps: int = SKETCH_STEPS) -> float:
    """Bound on the error of a statistic from two sketches.

    A sketch of size k gives all ranks at once within 2.446 / k^0.9433 (with a
    confidence of 99%); ranks are read to one step, and between two compared
    points lies one step at most.
    """
    return 2 * 2.446 / k**0.9433 + 2 / steps


def sketches(df: DataFrame, columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(column, sketch): a mergeable sketch of every column's values, in one pass; missing values are skipped."""
    wide = df.agg(*[F.kll_sketch_agg_double(tidy(c), F.lit(k)).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in columns])))


def ks_from_sketches(reference: DataFrame, current: DataFrame, alpha: float = 0.05, k: int = SKETCH_K, steps: int = SKETCH_STEPS) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per column, from sketches of both samples.

    The ranks of both are compared at the quantiles of both.  ``drift_detected`` holds if
    the test is significant at the least statistic the error leaves possible,
    ``drift_possible`` if it is at the greatest.  A column without values on
    either side has no statistic.
    """
    pairs = reference.select("column", F.col("sketch").alias("_ref")).join(
        F.broadcast(current.select("column", F.col("sketch").alias("_cur"))), "column"
    )
    counted = pairs.withColumns(
        {"reference_rows": F.kll_sketch_get_n_double("_ref"), "current_rows": F.kll_sketch_get_n_double("_cur")}
    )
    both = (F.col("reference_rows") > 0) & (F.col("current_rows") > 0)
    shares = F.lit([i / steps for i in range(steps + 1)])
    # An empty sketch has no quantiles to ask for: its rows stay out of the expression.
    asked = counted.where(both).select(
        "column", F.kll_sketch_get_quantile_double("_ref", shares).alias("_r"), F.kll_sketch_get_quantile_double("_cur", shares).alias("_c")
    )
    sides = [asked.select("column", F.explode(f"_{s}").alias("at"), F.lit(s).alias("side")) for s in "rc"]
    # Some thousand points a column: the quantiles of one sample up to a point give its rank.
    upto = Window.partitionBy("column").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)

    def rank(side: str) -> Column:
        return F.greatest(F.sum((F.col("side") == side).cast("int")).over(upto) - 1, F.lit(0)) / F.lit(float(steps))

    gaps = sides[0].unionByName(sides[1]).withColumn("gap", F.abs(rank("r") - rank("c")))
    found = gaps.groupBy("column").agg(F.max("gap").alias("ks_statistic"))
    n, m, error = F.col("reference_rows").cast("double"), F.col("current_rows").cast("double"), sketch_error(k, steps)
    d = F.col("ks_statistic")
    return (
        counted.drop("_ref", "_cur")
        .join(F.broadcast(found), "column", "left")
        .withColumns(
            {
                "error_bound": num(error),
                "p_value": ks_p(d, n, m),
                "drift_detected": F.coalesce(ks_p(F.greatest(d - error, num(0)), n, m) < alpha, F.lit(False)),
                "drift_possible": F.coalesce(ks_p(d + error, n, m) < alpha, F.lit(False)),
            }
        )
    )


def ks_drift_continuous(df: DataFrame, columns: Sequence[str], above: int = 10, alpha: float = 0.05) -> DataFrame:
    """As :func:`ks_drift`, but only for columns with more distinct reference values."""
    continuous = F.col("distinct_reference") > above
    return ks_drift(df, columns, alpha).select(
        "column",
        "distinct_reference",
        F.when(continuous, F.col("ks_statistic")).alias("ks_statistic"),
        F.when(continuous, F.col("p_value")).alias("p_value"),
        (continuous & F.col("drift_detected")).alias("drift_detected"),
    )


def moment_shift(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Relative shift of mean and sample deviation, 0 where the base is 0.

    The base keeps its sign, so the shift of a column with a negative mean is
    negative.  One aggregation serves both samples and all columns.
    """
    current = F.col(CURRENT)
    stats = []
    for c in columns:
        old, new = F.when(~current, tidy(c)), F.when(current, tidy(c))
        stats += [
            F.avg(old).alias(f"m0_{c}"),
            F.avg(new).alias(f"m1_{c}"),
            F.stddev_samp(old).alias(f"s0_{c}"),
            F.stddev_samp(new).alias(f"s1_{c}"),
        ]
    long = to_long(df.agg(*stats), list(columns), {"m0": "m0_{}", "m1": "m1_{}", "s0": "s0_{}", "s1": "s1_{}"})

    def shift(old: str, new: str) -> Column:
        return F.coalesce(ratio(F.abs(F.col(new) - F.col(old)), F.col(old)), num(0))

    return long.select("column", shift("m0", "m1").alias("mean_shift"), shift("s0", "s1").alias("std_shift"))


def drift_alarms(df: DataFrame, columns: Sequence[str], limit: float = 0.1, above: int = 10) -> DataFrame:
    """Alarm per column on a mean or deviation shift or a significant test.

    ``noteworthy`` is the narrower condition of the summary: mean shift or test.
    """
    tests = ks_drift_continuous(df, columns, above)
    shifts = moment_shift(df, columns)
    # One row per column named on either side.
    joined = shifts.join(F.broadcast(tests), "column", "left")
    tested = F.coalesce(F.col("drift_detected"), F.lit(False))
    return joined.select(
        "column",
        "mean_shift",
        "std_shift",
        "ks_statistic",
        "p_value",
        ((F.col("mean_shift") > limit) | (F.col("std_shift") > limit) | tested).alias("alarm"),
        ((F.col("mean_shift") > limit) | tested).alias("noteworthy"),
    )


def drifted_count(tests: DataFrame, flag: str = "drift_detected") -> DataFrame:
    return tests.agg(
        tally(F.coalesce(F.col(flag), F.lit(False))).alias("drifted"), F.count(F.lit(1)).alias("columns")
    )


def performance_drift(df: DataFrame, period: Column, actual: str, predicted: str, limit: float = 0.05) -> DataFrame:
    """R2 per period against the R2 over all rows; drift on a larger relative drop.

    Sums per period are enough for both, so the rows are read once.
    """
    r = F.col(actual) - F.col(predicted)
    sums = df.groupBy(period.alias("period")).agg(
        F.count(actual).alias("n"),
        F.sum(r * r).alias("sse"),
        F.var_pop(actual).alias("var"),
        F.avg(actual).alias("mean"),
    )
    # Pooled variance over all periods, within plus between.  The window runs
    # over one row per period.
    n, mean = F.col("n"), F.col("mean")

    def over_all(value: Column) -> Column:
        return F.sum(value).over(Window.partitionBy())

    between = over_all(n * mean * mean) - ratio(over_all(n * mean) * over_all(n * mean), over_all(n))
    baseline = 1.0 - ratio(over_all(F.col("sse")), over_all(n * F.col("var")) + between)
    return (
        sums.select(
            "period", "n", (1.0 - ratio(F.col("sse"), n * F.col("var"))).alias("r2"), baseline.alias("baseline_r2")
        )
        .withColumn("drop", ratio(F.col("baseline_r2") - F.col("r2"), F.col("baseline_r2")))
        .withColumn("drifted", F.coalesce(F.col("drop") > limit, F.lit(False)))
    )


def retrain_decision(
    state: DataFrame, r2_drop: float = 0.10, drift_share: float = 0.15, every_months: int = 1, gain: float = 0.02
) -> DataFrame:
    """Whether to retrain, why, and whether a candidate is worth promoting.

    Needs last_trained and as_of (dates), baseline_r2, current_r2,
    drift_score and candidate_r2.
    """
    due = F.add_months("last_trained", every_months) <= F.col("as_of")
    degraded = ratio(F.col("baseline_r2") - F.col("current_r2"), F.col("baseline_r2")) >= r2_drop
    drifted = F.col("drift_score") >= drift_share
    return state.select(
        due.alias("schedule_due"),
        degraded.alias("performance_degraded"),
        drifted.alias("data_drifted"),
        (due | degraded | drifted).alias("retrain"),
        (ratio(F.col("candidate_r2") - F.col("current_r2"), F.col("current_r2")) >= gain).alias("promote"),
    )
