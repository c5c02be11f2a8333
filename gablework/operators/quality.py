"""Cleaning, record validation and data-quality scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from gablework.functions.columns import fetched, num, scalars, share, tally, tidy, to_long
from gablework.operators.ranking import quantiles, quantiles_from_counts, value_counts_long
from gablework.roles import QUALITY_WEIGHTS, Rule


class QualityError(ValueError):
    """A gate did not pass."""


def rule_holds(rule: Rule, use_allowed: bool = False) -> Column:
    """Whether a row keeps a rule; a missing value keeps none."""
    value = F.col(rule.column)
    checks = []
    if rule.low is not None:
        checks.append(value > num(rule.low) if rule.strict else value >= num(rule.low))
    if rule.high is not None:
        checks.append(value < num(rule.high) if rule.strict else value <= num(rule.high))
    if rule.allowed is not None and use_allowed:
        checks.append(value.isin(*rule.allowed))
    held = checks[0] if checks else F.lit(True)
    for check in checks[1:]:
        held = held & check
    return F.coalesce(held, F.lit(False))


def all_hold(rules: Sequence[Rule]) -> Column:
    held = F.lit(True)
    for rule in rules:
        held = held & rule_holds(rule)
    return held


def clean_by_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows that satisfy every rule; one fused predicate in one filter.

    Bounds are stated plainly, without the NULL guard, so that those on stored
    columns reach the parquet scan.
    """
    for rule in rules:
        value = F.col(rule.column)
        if rule.low is not None:
            df = df.where(value > num(rule.low) if rule.strict else value >= num(rule.low))
        if rule.high is not None:
            df = df.where(value < num(rule.high) if rule.strict else value <= num(rule.high))
    return df


def _fence(df: DataFrame, column: str) -> tuple[Column, Column]:
    q = fetched(quantiles(df, [column], [0.25, 0.75]).select("p25", "p75"))
    reach = (q["p75"] - q["p25"]) * num(1.5)
    return q["p25"] - reach, q["p75"] + reach


def clean_by_iqr(df: DataFrame, columns: Sequence[str] = ("area", "price")) -> DataFrame:
    """Drop rows outside the quartile fences, one column after the other.

    The quartiles of a later column are those of the rows the earlier ones
    left.  Pass a staged frame: it is read once per column and once more.
    """
    for column in columns:
        low, high = _fence(df, column)
        df = df.where((F.col(column) >= low) & (F.col(column) <= high))
    return df


def outlier_report(df: DataFrame, columns: Sequence[str], samples: int = 5) -> DataFrame:
    """Per column: fences, number and share of outliers, lowest outlying values.

    Everything comes from the value counts, so the input is read once.
    """
    counted = value_counts_long(df, columns)
    q = quantiles_from_counts(counted, [0.25, 0.75])
    reach = (F.col("p75") - F.col("p25")) * num(1.5)
    fences = q.select("column", (F.col("p25") - reach).alias("lower"), (F.col("p75") + reach).alias("upper"))
    # As many rows as columns were named.
    judged = counted.join(F.broadcast(fences), "column")
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    per_column = judged.groupBy("column").agg(
        F.max("lower").alias("lower"),
        F.max("upper").alias("upper"),
        F.sum(F.when(out, F.col("n")).otherwise(0)).cast("bigint").alias("outliers"),
        (F.sum(F.when(out, F.col("n")).otherwise(0)) / F.sum("n") * 100.0).alias("percent"),
    )
    place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    lowest = (
        judged.where(out)
        .withColumn("_place", place)
        .where(F.col("_place") <= samples)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("_values"))
    )
    shown = F.array_join(F.transform("_values", lambda v: F.format_string("%.2f", v)), ", ")
    return per_column.join(F.broadcast(lowest), "column", "left").select(
        *per_column.columns, F.coalesce(shown, F.lit("")).alias("sample_values")
    )


def removal_report(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, counted in one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("initial_rows"), tally(kept).alias("final_rows"))
    removed = F.col("initial_rows") - F.col("final_rows")
    return counted.select(
        "initial_rows",
        "final_rows",
        removed.alias("removed_rows"),
        F.coalesce(F.try_divide(removed * 100.0, F.col("initial_rows")), num(0)).alias("removed_percent"),
    )


def check_records(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``is_valid`` and ``reasons``, the names of the columns out of bounds."""
    broken = F.array_compact(F.array(*[F.when(~rule_holds(r), F.lit(r.column)) for r in rules]))
    return df.withColumn("reasons", broken).withColumn("is_valid", F.size("reasons") == 0)


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the rejected ones with their reasons."""
    checked = check_records(df, rules)
    return (
        checked.where("is_valid").drop("is_valid", "reasons"),
        checked.where("not is_valid").drop("is_valid"),
    )


def rule_scores(df: DataFrame, rules: Sequence[Rule], use_allowed: bool = False) -> DataFrame:
    """Share of valid rows per rule: ``feature, valid_rows, total_rows, score``.

    Only rules with both limits count, unless ``use_allowed`` asks for value
    lists as well.  Columns the frame lacks are passed over.
    """
    used = [
        r
        for r in rules
        if r.column in df.columns
        and ((r.low is not None and r.high is not None) or (use_allowed and r.allowed is not None))
    ]
    counts = [tally(rule_holds(r, use_allowed)).alias(f"valid_{r.column}") for r in used]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    long = to_long(wide, [r.column for r in used], {"valid_rows": "valid_{}", "total_rows": "total"}, "feature")
    return long.withColumn("score", F.try_divide(F.col("valid_rows") * 1.0, F.col("total_rows")))


def conformance(
    df: DataFrame, rules: Sequence[Rule], expected: Sequence[str], threshold: float = 0.95
) -> DataFrame:
    """Overall rule score and whether the frame passes as valid."""
    complete = not missing_columns(df, expected)
    return rule_scores(df, rules).agg(F.coalesce(F.avg("score"), num(0)).alias("overall_score")).select(
        "overall_score",
        F.lit(complete).alias("schema_compliance"),
        (F.lit(complete) & (F.col("overall_score") >= threshold)).alias("is_valid"),
    )


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def same_order(df: DataFrame, expected: Sequence[str]) -> bool:
    return list(df.columns) == list(expected)


def schema_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: present, and at the expected position."""
    rows = [
        (c, c in df.columns, c in df.columns and i < len(df.columns) and df.columns[i] == c)
        for i, c in enumerate(expected)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean, in_place boolean")


def quality_score(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str] | None = None) -> DataFrame:
    """Weighted data-quality score of the rows that pass the rules.

    Completeness is taken over the clean rows, validity is their share of all
    rows; consistency and accuracy are taken as given.
    """
    columns = list(columns or df.columns)
    kept = all_hold(rules)
    nulls = sum((F.when(tidy_null(df, c), 1).otherwise(0) for c in columns), F.lit(0))
    base = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        tally(kept).alias("_kept"),
        F.sum(F.when(kept, nulls).otherwise(0)).alias("_nulls"),
    )
    cells = F.col("_kept") * len(columns)
    parts = base.select(
        (1.0 - F.coalesce(F.try_divide(F.col("_nulls") * 1.0, cells), num(0))).alias("completeness"),
        F.coalesce(F.try_divide(F.col("_kept") * 1.0, F.col("_rows")), num(0)).alias("validity"),
        num(1).alias("consistency"),
        num(1).alias("accuracy"),
    )
    score = sum((F.col(name) * w for name, w in QUALITY_WEIGHTS.items()), num(0))
    return parts.withColumn("quality_score", score)


def tidy_null(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def require(gate: DataFrame, condition: Column, message: str) -> None:
    """Stop the job when a one-row gate frame does not meet the condition."""
    row = gate.select(F.coalesce(condition, F.lit(False)).alias("ok"), F.to_json(F.struct("*")).alias("seen")).first()
    if row is None or not row["ok"]:
        raise QualityError(f"{message}: {row['seen'] if row else 'no rows'}")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column and in total (row ``(all)``), from one scan."""
    columns = list(columns or df.columns)
    wide = df.agg(*[tally(tidy_null(df, c)).alias(f"nulls_{c}") for c in columns])
    wide = wide.withColumn("nulls_(all)", sum((F.col(f"`nulls_{c}`") for c in columns), F.lit(0)).cast("bigint"))
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"`nulls_{c}`").alias("nulls")) for c in [*columns, "(all)"]
    ]
    return wide.select(F.inline(F.array(*rows)))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing numbers with the exact median of their column."""
    one_row = quantiles(df, columns, [0.5]).agg(
        *[F.max(F.when(F.col("column") == c, F.col("p50"))).alias(c) for c in columns]
    )
    medians = fetched(one_row)
    return df.withColumns({c: F.coalesce(tidy(c), medians[c]) for c in columns})


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing numbers with the mean of their column."""
    means = scalars(df.agg(*[F.avg(tidy(c)).alias(c) for c in columns]))
    return df.withColumns({c: F.coalesce(tidy(c), means[c]) for c in columns})


def size_requirement(
    df: DataFrame, features: int, low: int = 100, high: int = 100_000, min_features: int = 5
) -> DataFrame:
    """Whether the number of rows and features suits a training run."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(features).alias("features"),
        F.col("rows").between(low, high).alias("rows_ok"),
        F.lit(features >= min_features).alias("features_ok"),
    )


def mask_share(df: DataFrame, mask: Column) -> DataFrame:
    """Rows under a combined mask, and their share."""
    return df.agg(tally(mask).alias("rows"), share(mask).alias("fraction"))
