"""Derived features, label codes, scaling and rule prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import num, ratio, scalars, tidy
from gablework.operators.ranking import number_rows
from gablework.session import stage


class NotFittedError(ValueError):
    """A fitted artefact is needed and none was given."""


# --- derived columns -------------------------------------------------------


def area_per_room() -> Column:
    return F.col("area") / (F.col("bedrooms") + 1)


def bathroom_ratio() -> Column:
    """NULL for a listing without bedrooms."""
    return ratio(F.col("bathrooms"), F.col("bedrooms"))


def age_squared() -> Column:
    return F.col("age_years") * F.col("age_years")


def total_rooms() -> Column:
    return F.col("bedrooms") + F.col("bathrooms")


def is_new(limit: float = 5) -> Column:
    """1 below the age limit, else 0 (also for an unknown age)."""
    return F.coalesce(F.col("age_years") < num(limit), F.lit(False)).cast("int")


def derive_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "area_per_room": area_per_room(),
            "bathroom_ratio": bathroom_ratio(),
            "age_squared": age_squared(),
            "total_rooms": total_rooms(),
            "is_new": is_new(),
        }
    )


def select_features(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """The feature list in model order, after any columns to keep."""
    return df.select(*keep, *features)


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """One vector column; rows with a missing feature are left out."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip").transform(df)


# --- rule prices -----------------------------------------------------------


def rule_price(
    weights: dict[str, float],
    factors: dict[str, float] | None = None,
    factor: Column | None = None,
    floor: float | None = None,
    absolute: bool = False,
) -> Column:
    """Weighted sum of columns times a factor per district, as one expression.

    ``factors`` is a short fixed list and becomes a CASE; ``factor`` takes the
    value from a column instead, say after a lookup join.
    """
    total = None
    for column, weight in weights.items():
        term = num(abs(weight)) * F.col(column)
        if total is None:
            total = term if weight >= 0 else -term
        else:
            total = total + term if weight >= 0 else total - term
    if factors is not None:
        factor = None
        for name, value in factors.items():
            hit = F.col("district") == name
            factor = F.when(hit, num(value)) if factor is None else factor.when(hit, num(value))
    if factor is not None:
        total = total * factor
    if absolute:
        total = F.abs(total)
    if floor is not None:
        total = F.greatest(total, num(floor))
    return total


def factor_table(df: DataFrame, factors: dict[str, float]) -> DataFrame:
    """A fixed lookup (district, factor) as a frame; as short as the dictionary."""
    rows = [(name, float(value)) for name, value in factors.items()]
    return df.sparkSession.createDataFrame(rows, "district string, factor double")


def join_factors(df: DataFrame, factors: dict[str, float]) -> DataFrame:
    """Equi join with the lookup; its size is that of the dictionary given."""
    return df.join(F.broadcast(factor_table(df, factors)), "district")


def clip(column: str | Column, low: float, high: float) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    # greatest/least skip NULL, so a missing value must be kept missing.
    return F.when(value.isNotNull(), F.greatest(F.least(value, num(high)), num(low)))


# --- label codes -----------------------------------------------------------


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """Codes of the sorted distinct labels, from 0: ``label, code``.

    Written out like any fitted artefact.  Read back, its size is known, and
    Catalyst broadcasts it or shuffles by that size when it is applied.
    """
    labels = df.select(F.col(column).cast("string").alias("label")).where("label is not null").distinct()
    coded = number_rows(labels, [F.col("label")], "code").select("label", (F.col("code") - 1).alias("code"))
    return stage(coded, "labels")


def apply_labels(
    df: DataFrame,
    labels: DataFrame | None,
    column: str,
    output: str,
    unknown: str = "default",
    default: int = 0,
) -> DataFrame:
    """Add the code of each label.

    ``unknown="default"`` gives labels never seen the default code;
    ``"error"`` fails the job when one turns up.
    """
    if labels is None:
        raise NotFittedError("label encoder not fitted; fit it on the training data first")
    book = labels.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
    joined = df.join(book, F.col(column).cast("string") == F.col("_label"), "left")
    if unknown == "error":
        message = F.concat(F.lit(f"label not seen in fitting, column {column}: "), F.coalesce(column, F.lit("NULL")))
        code = F.coalesce(F.col("_code"), F.raise_error(message).cast("int"))
    else:
        code = F.coalesce(F.col("_code"), F.lit(default))
    return joined.withColumn(output, code).drop("_label", "_code")


def unknown_labels(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Labels of ``df`` absent from the fitted ones, with their row counts."""
    seen = df.groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return seen.join(labels.select("label"), "label", "left_anti")


def encode_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each string column by its codes (missing text counts as 'nan')."""
    for column in columns:
        filled = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("nan")))
        labels = fit_labels(filled, column)
        df = apply_labels(filled, labels, column, f"_{column}").drop(column).withColumnRenamed(f"_{column}", column)
    return df


# --- scaling ---------------------------------------------------------------


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of means and population deviations; a zero deviation becomes 1."""
    stats = []
    for c in columns:
        spread = F.stddev_pop(tidy(c))
        stats.append(F.avg(tidy(c)).alias(f"mean_{c}"))
        stats.append(F.when(spread == 0, 1.0).otherwise(spread).alias(f"scale_{c}"))
    return train.agg(*stats)


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    fitted = scalars(scaler)
    return df.withColumns({c: (F.col(c) - fitted[f"mean_{c}"]) / fitted[f"scale_{c}"] for c in columns})
