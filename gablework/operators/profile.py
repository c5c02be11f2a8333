"""Profiling: descriptions, counts, group statistics, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from gablework.functions.columns import num, ratio, scalar, scalars, tally, tidy, to_long
from gablework.functions.stats import normal_quantile
from gablework.operators.ranking import (
    cumulate,
    number_rows,
    quantiles,
    quantiles_from_counts,
    value_counts_long,
)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per column.

    Two passes, one for the moments and one for the exact quartiles; pass a
    staged frame when the input is a join.
    """
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    # One wide row: the input is neither multiplied by the columns nor moved.
    wide = df.agg(*[f(tidy(c)).alias(f"{name}_{c}") for c in columns for name, f in measures.items()])
    moments = to_long(wide, list(columns), {name: f"{name}_{{}}" for name in measures})
    cuts = quantiles(df, columns, [0.25, 0.5, 0.75]).drop("n")
    # Both sides have one row per column named.
    return moments.join(F.broadcast(cuts), "column", "left")


def shape_report(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the number of rows."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    types = df.sparkSession.createDataFrame(rows, "position int, column string, type string")
    total = scalar(df.agg(F.count(F.lit(1)).alias("n")), "n")
    return types.select("*", total.alias("rows"), F.lit(len(rows)).alias("columns"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage, two decimals."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = scalar(counts.agg(F.sum("n").alias("total")), "total")
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 2))


def group_stats(df: DataFrame, by: str, target: str, others: Sequence[str], digits: int = 2) -> DataFrame:
    """Target statistics per group and the mean of other columns.

    ``df`` is read twice: for the moments and for the exact medians.
    """
    moments = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(target).alias("n"),
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
        F.min(target).alias("min"),
        F.max(target).alias("max"),
        *[F.avg(c).alias(f"mean_{c}") for c in others],
    )
    medians = quantiles(df, [target], [0.5], [by]).select(by, F.col("p50").alias("median"))
    joined = moments.join(medians, by, "left")
    exact = {by, "n"}
    return joined.select(*[c if c in exact else F.round(c, digits).alias(c) for c in joined.columns])


def group_ranking(df: DataFrame, by: str, target: str) -> DataFrame:
    """Groups numbered by falling mean of the target (ties by name)."""
    means = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(target).alias("mean"))
    return number_rows(means, [-F.col("mean"), F.col(by)])


def group_share(df: DataFrame, by: str, flag: str) -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg((F.avg(flag) * 100.0).alias("percent"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Mean, median, deviation, range, quartiles and coefficient of variation."""
    return describe(df, [target]).select(
        "mean",
        F.col("p50").alias("median"),
        "std",
        "min",
        "max",
        F.col("p25").alias("q1"),
        F.col("p75").alias("q3"),
        (F.col("std") / F.col("mean") * 100.0).alias("variation_percent"),
    )


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``column_a, column_b, correlation`` for a list of column pairs.

    Each row is laid out once per pair and aggregated by pair before anything
    is shuffled.  One aggregation with a buffer for every pair would be too
    wide for compiled code.
    """
    used = list(dict.fromkeys(c for pair in pairs for c in pair))
    values = df.select(*[tidy(c).alias(c) for c in used])
    listed = ", ".join(f"'{a}', '{b}', `{a}`, `{b}`" for a, b in pairs)
    laid = values.select(F.expr(f"stack({len(pairs)}, {listed}) AS (column_a, column_b, _a, _b)"))
    return laid.groupBy("column_a", "column_b").agg(F.corr("_a", "_b").alias("correlation"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all pairs in one pass, long."""
    half = _pair_correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    both = F.array(
        F.struct("column_a", "column_b", "correlation"),
        F.struct(
            F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), F.col("correlation")
        ),
    )
    one = F.slice(both, 1, 1)
    return half.select(F.inline(F.when(F.col("column_a") == F.col("column_b"), one).otherwise(both)))


def correlation_ranking(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation with the target, ranked by size, with strength and direction."""
    long = _pair_correlations(df, [(c, target) for c in columns]).select(
        F.col("column_a").alias("column"), "correlation"
    )
    size = F.abs("correlation")
    # One row per column named, so the window is as short as the call.
    place = Window.orderBy(size.desc_nulls_last(), "column")
    return long.select(
        "column",
        "correlation",
        F.when(size > 0.7, "strong").when(size > 0.3, "moderate").otherwise("weak").alias("strength"),
        F.when(F.col("correlation") > 0, "positive").otherwise("negative").alias("direction"),
        F.row_number().over(place).alias("rank"),
    )


def histogram(df: DataFrame, value: Column, bins: int = 30) -> DataFrame:
    """Equal-width bins over the range of the values, the last one closed.

    All bins are listed, empty ones with 0.
    """
    values = df.select(tidy(value).alias("v"))
    span = scalars(values.agg(F.min("v").alias("low"), F.max("v").alias("high")))
    width = (span["high"] - span["low"]) / bins
    place = F.least(F.floor(F.coalesce(ratio(F.col("v") - span["low"], width), num(0))), F.lit(bins - 1))
    counts = values.where("v is not null").groupBy(place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # ``counts`` has at most one row per bin.
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (span["low"] + F.col("bin") * width).alias("lower"),
        (span["low"] + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def box_table(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whisker ends, outliers.

    Quartiles and counts both come from the value counts, so the input is read
    once; the second use re-reads the counting shuffle.
    """
    counted = value_counts_long(df, [value], [by])
    q = quantiles_from_counts(counted, [0.25, 0.5, 0.75], [by, "column"]).drop("n", "column")
    judged = counted.join(q, by)
    reach = (F.col("p75") - F.col("p25")) * num(1.5)
    inside = F.col("value").between(F.col("p25") - reach, F.col("p75") + reach)
    return judged.groupBy(by).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.max("p25").alias("q1"),
        F.max("p50").alias("median"),
        F.max("p75").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).cast("bigint").alias("outliers"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], continuous_above: int = 10) -> DataFrame:
    """Distinct values per column, and whether the column counts as continuous.

    Values are deduplicated per column first, so no group is ever held whole.
    """
    per_column = value_counts_long(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return per_column.withColumn("continuous", F.col("distinct_values") > continuous_above)


def category_listing(df: DataFrame, column: str) -> DataFrame:
    """The distinct categories, each with the total number of them."""
    names = df.select(F.col(column).alias("category")).where("category is not null").distinct()
    total = scalar(names.agg(F.count(F.lit(1)).alias("n")), "n")
    return names.withColumn("total_count", total)


def mean_and_spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = df.select(*[tidy(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return values.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


def head(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first rows in an explicit order (a partial top-n per task)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The last rows in an explicit order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def normal_plot(df: DataFrame, value: Column) -> DataFrame:
    """Points of a normal Q-Q plot, one row per distinct value.

    Equal values share a run of ranks, given by its first and last; the
    theoretical quantiles are those of the order-statistic medians
    (Filliben's estimate).
    """
    values = df.select(tidy(value).alias("value")).where("value is not null")
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranked = cumulate(counted, "value", ["n"])
    total = F.col("total_n").cast("double")

    def theory(rank: Column) -> Column:
        end = F.pow(num(0.5), num(1) / total)
        middle = (rank - 0.3175) / (total + 0.365)
        return normal_quantile(F.when(rank == total, end).when(rank == 1, 1.0 - end).otherwise(middle))

    return ranked.select(
        "value",
        "n",
        (F.col("cum_n") - F.col("n") + 1).alias("first_rank"),
        F.col("cum_n").alias("last_rank"),
        theory(F.col("cum_n") - F.col("n") + 1).alias("first_quantile"),
        theory(F.col("cum_n")).alias("last_quantile"),
    )


def standardised_residuals(df: DataFrame, row_id: str, actual: str, predicted: str) -> DataFrame:
    """Residual over its sample deviation; the deviation is one aggregate, not a window."""
    r = F.col(actual) - F.col(predicted)
    spread = scalar(df.agg(F.stddev_samp(r).alias("s")), "s")
    return df.select(row_id, r.alias("residual"), ratio(r, spread).alias("standardised"))


def conditional_count(df: DataFrame, **flags: Column) -> DataFrame:
    return df.agg(*[tally(f).alias(name) for name, f in flags.items()])
