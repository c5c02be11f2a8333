"""Small column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def num(value: float) -> Column:
    """A DOUBLE literal; plain SQL decimals would round."""
    return F.lit(float(value))


def tidy(column: str | Column) -> Column:
    """As DOUBLE, with NaN turned to NULL so that it is skipped like a missing value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(value), value)


def ratio(top: Column, bottom: Column) -> Column:
    """Division as DOUBLE, NULL on a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def scalar(one_row: DataFrame, column: str) -> Column:
    """A column of a one-row frame as a scalar subquery.

    Spark evaluates it once and hands the value to the tasks as a constant.
    """
    return one_row.select(column).scalar()


def scalars(one_row: DataFrame) -> dict[str, Column]:
    """All columns of a one-row frame, read through a single scalar subquery."""
    packed = one_row.select(F.struct(*one_row.columns).alias("s")).scalar()
    return {name: packed[name] for name in one_row.columns}


def fetched(one_row: DataFrame) -> dict[str, Column]:
    """The columns of a one-row frame as literals, computed now.

    For statistics that come out of a long plan of their own and steer another
    pass: the second plan stays short, and its filters reach the scan.
    """
    rows = one_row.take(2)
    if len(rows) > 1:
        raise ValueError("a frame of one row is needed")
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return {name: F.lit(rows[0][name] if rows else None).cast(kind) for name, kind in types.items()}


BROADCAST_BYTES = 32 * 1024 * 1024


def bytes_of(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size; for a scan, that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, *inputs: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if the files it is joined from are small.

    For lookups on unique keys, whose size is that of the inputs; Catalyst
    multiplies the sizes of joined inputs and so takes such a lookup for huge.
    Above the limit there is no hint and the join is shuffled.
    """
    size = sum(bytes_of(i) for i in inputs)
    return F.broadcast(df) if size <= limit else df


def share(flag: Column) -> Column:
    """Fraction of rows for which the flag holds; NULL flags count as rows."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0))


def tally(flag: Column) -> Column:
    return F.count_if(flag).cast("bigint")


def to_long(one_row: DataFrame, names: list[str], values: dict[str, str], label: str = "column") -> DataFrame:
    """Turn a wide one-row report into one row per name.

    ``values`` maps an output column to the pattern of the wide columns,
    e.g. ``{"nulls": "nulls_{}"}``.
    """
    rows = [
        F.struct(F.lit(n).alias(label), *[F.col(p.format(n)).alias(v) for v, p in values.items()])
        for n in names
    ]
    return one_row.select(F.inline(F.array(*rows)))
