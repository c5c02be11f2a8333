"""Exact ranks, cumulative counts and quantiles without a single-task sort.

Everything here works on *value counts*: one row per distinct value, already
reduced map-side.  The distinct values are cut into ranges of about equal size
by a small sample, each range is ordered on its own, and the running totals of
the ranges (a table as small as the sample) lift the local positions to global
ones.  A value that holds a third of all rows is one row here, so it cannot
make a task heavy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from gablework.functions.columns import fetched, scalar, tidy


def default_slots(df: DataFrame) -> int:
    """Number of ranges: grows with the shuffle width the cluster is set to."""
    return max(256, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def value_counts_long(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Count distinct values of several numeric columns in one pass.

    Gives ``keys, column, value`` and one column per entry of ``counts``
    (default ``n``, the number of rows).  NULL and NaN are left out.
    """
    counts = counts or {"n": F.count(F.lit(1))}
    # Only what the counts themselves name must survive the unpivot.
    carried = [c for c in df.columns if c not in columns and c not in keys and c.startswith("_")]
    wide = df.select(*keys, *carried, *[tidy(c).alias(c) for c in columns])
    long = wide.unpivot([*keys, *carried], list(columns), "column", "value")
    return (
        long.where(F.col("value").isNotNull())
        .groupBy(*keys, "column", "value")
        .agg(*[expr.alias(name) for name, expr in counts.items()])
    )


def _with_range(df: DataFrame, bounds: Column, value: str, width: int) -> DataFrame:
    """Add ``_range``: how many of at most ``width`` sorted bounds lie below ``value``.

    A binary search laid out as one projection per step, which whole-stage
    code generation fuses; a higher-order function would be interpreted.
    """
    step = 1
    while step * 2 <= width:
        step *= 2
    steps = [bounds.alias("_bounds")]
    at = "0"
    while step:
        below = f"coalesce(get(_bounds, {at} + {step - 1}) < `{value}`, false)"
        name = "_range" if step == 1 else f"_at{step}"
        steps.append(F.expr(f"{at} + if({below}, {step}, 0) AS {name}"))
        at, step = name, step // 2
    # Later columns of one select may use earlier ones; Spark turns the list
    # into stacked projections.
    return df.select("*", *steps).select(*df.columns, "_range")


def cumulate(
    counted: DataFrame,
    value: str,
    counts: Sequence[str],
    keys: Sequence[str] = (),
    scale: str | None = None,
    slots: int | None = None,
    wanted: Column | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum by ``value``) and ``total_<c>``.

    ``counted`` holds one row per ``keys + value``.  ``value`` may be of any
    orderable type, structs included.  ``scale`` names the key whose groups
    differ in the range of their values (the column name after an unpivot);
    it gets bounds of its own.  ``wanted`` is a condition on the ranges, stated
    over ``before_<c>``, ``sum_<c>`` and ``total_<c>``: ranges that fail it are
    neither shuffled nor sorted nor returned.  Rows with a NULL key are dropped, as a pandas
    group-by drops them.
    """
    slots = slots or default_slots(counted)
    keys = list(keys)
    mark = F.xxhash64(*keys, value)
    # Reading the counts keeps all uses of ``counted`` identical after column
    # pruning, so its shuffle is written once and reused.
    present = sum((F.col(c) for c in counts), F.lit(0)) >= 0
    for key in keys:
        present = present & F.col(key).isNotNull()
    scale_cols = [scale] if scale else []
    sample = (
        counted.where(present)
        .groupBy(*scale_cols, F.pmod(mark, F.lit(slots)).alias("_slot"))
        .agg(F.min_by(value, mark).alias("_bound"))
    )
    bounds = sample.groupBy(*scale_cols).agg(F.array_sort(F.collect_list("_bound")).alias("_bounds"))
    if scale:
        table = bounds.agg(F.map_from_entries(F.collect_list(F.struct(scale, "_bounds"))).alias("m"))
        lookup = scalar(table, "m")[F.col(scale)]
    else:
        lookup = scalar(bounds, "_bounds")
    # ``_range`` is never NULL; otherwise the join below would push a null test
    # on it under the counting and keep the counting shuffle from being reused.
    ranged = _with_range(counted.where(present), lookup, value, slots)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"sum_{c}") for c in counts])
    totals = totals.select(
        *keys,
        "_range",
        *[f"sum_{c}" for c in counts],
        *[F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0)).alias(f"before_{c}") for c in counts],
        *[F.sum(f"sum_{c}").over(whole).alias(f"total_{c}") for c in counts],
    )
    if wanted is not None:
        totals = totals.where(wanted)
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(totals, [*keys, "_range"]).select(
        *[c for c in counted.columns],
        *[(F.col(f"before_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in counts],
        *[f"total_{c}" for c in counts],
    )


def quantile_name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def quantiles_from_counts(
    counted: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("column",), scale: str | None = "column"
) -> DataFrame:
    """Exact linear-interpolation quantiles from a value-count table.

    One row per ``keys`` with ``n`` and ``p25``-style columns.
    """
    # Only the few ranges that hold a wanted position need ordering.
    holds = F.lit(False)
    for p in probs:
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        holds = holds | (
            (F.ceil(at) >= F.col("before_n")) & (F.floor(at) < F.col("before_n") + F.col("sum_n"))
        )
    ranked = cumulate(counted, "value", ["n"], keys, scale, wanted=holds)
    picks = []
    for p in probs:
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank)
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"_{side}_{quantile_name(p)}"))
    picked = ranked.groupBy(*keys).agg(F.max("total_n").alias("n"), *picks)
    out = [*keys, "n"]
    for p in probs:
        name = quantile_name(p)
        at = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picked.select(*out)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of several columns, long: ``keys, column, n, p..``."""
    return quantiles_from_counts(value_counts_long(df, columns, keys), probs, [*keys, "column"])


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Consecutive numbers from 1 in the given order, over all rows.

    The order must be total; express "descending" by negating the number.
    """
    keyed = df.withColumn("_order", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    ranked = cumulate(keyed.withColumn("_one", F.lit(1).cast("bigint")), "_order", ["_one"])
    return ranked.withColumn(name, F.col("cum__one").cast("int")).drop(
        "_order", "_one", "cum__one", "total__one"
    )


def smallest_hash_cut(df: DataFrame, digest: Column, size: Column) -> Column:
    """The digest below or at which exactly ``size`` rows lie, as a scalar.

    ``digest`` is a hex string with evenly spread digits.  Two histograms over
    digit prefixes narrow the cut to about n / 2**32 rows; only those are
    ordered.  The rows themselves are never shuffled or sorted, and the cut is
    a literal.  ``size`` may use the column ``total``, the number of rows.
    NULL for size 0.  Reads ``df`` three times, the digest columns only.
    """
    hashed = df.select(digest.alias("h"))
    running = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def level(rows: DataFrame, prefix: Column, wanted: Column) -> tuple[Column, Column]:
        hist = rows.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("c"))
        cut = (
            hist.withColumn("total", F.sum("c").over(Window.partitionBy()))
            .select("p", "c", wanted.cast("bigint").alias("wanted"), F.sum("c").over(running).alias("cum"))
            .where((F.col("cum") >= F.col("wanted")) & (F.col("wanted") > 0))
            .agg(F.min(F.struct("p", (F.col("wanted") - F.col("cum") + F.col("c")).alias("rest"))).alias("s"))
        )
        found = fetched(cut.select("s.p", "s.rest"))
        return found["p"], found["rest"]

    first, rest = level(hashed, F.substring("h", 1, 4), size)
    narrow = hashed.where(F.substring("h", 1, 4) == first)
    second, rest = level(narrow, F.substring("h", 1, 8), rest)
    narrow = narrow.where(F.substring("h", 1, 8) == second)
    cut, _ = level(narrow, F.col("h"), rest)
    return cut
