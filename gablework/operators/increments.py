"""Profiles kept up to date by states: a new folder of rows needs no rescan of the old ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gablework.functions.columns import tidy
from gablework.operators.drift import SKETCH_K
from gablework.sources.manifest import Store

#: Registers of a distinct count are 2 to this power: a standard error of 0.8%.
DISTINCT_LOG2 = 14
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def rank_error(k: int = SKETCH_K) -> float:
    """Bound on the rank error of a quantile, with a confidence of 99%."""
    return 2.446 / k**0.9433


def profile_states(rows: DataFrame, columns: Sequence[str], by: str = "folder", k: int = SKETCH_K) -> DataFrame:
    """A mergeable state per ``by`` and column, in one pass: count, mean, sum of squared deviations, ends, two sketches.

    Missing values are skipped.
    """
    measures = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "m2": lambda c: F.var_pop(c) * F.count(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "ranks": lambda c: F.kll_sketch_agg_double(c, F.lit(k)),
        # Adding zero makes a negative zero a plain one.
        "values": lambda c: F.hll_sketch_agg((c + F.lit(0.0)).cast("string"), F.lit(DISTINCT_LOG2)),
    }
    wide = rows.groupBy(by).agg(*[f(tidy(c).cast("double")).alias(f"{name}_{c}") for c in columns for name, f in measures.items()])
    states = [F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{c}").alias(m) for m in measures]) for c in columns]
    return wide.select(by, F.inline(F.array(*states)))


def add_folders(
    store: Store, folders: Sequence[str], columns: Sequence[str], read: Callable[[str], DataFrame] | None = None, k: int = SKETCH_K
) -> list[str]:
    """Profile the folders that ``store`` does not hold yet, in one job, and commit their states; their names.

    A folder is taken as final: rows added to it later are not seen.  A run
    that fails leaves the store as it was.
    """
    known = {r[0] for r in store.read().select("folder").distinct().collect()} if store.numbers() else set()
    new = sorted(set(folders) - known)
    if new:
        read = read or store.spark.read.parquet
        rows = [read(f).select(*columns).withColumn("folder", F.lit(f)) for f in new]
        store.append(profile_states(reduce(DataFrame.unionByName, rows), columns, k=k))
    return new


def merged_profile(states: DataFrame) -> DataFrame:
    """One row per column over all states: moments exact, quartiles and distinct values from sketches.

    Reads the states only, a row per folder and column.  A folder that two
    writers added counts once.  A column without values has a count of 0 and
    nulls.
    """
    parts = states.dropDuplicates(["folder", "column"])
    centre = parts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("centre"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    # One row per column named.
    off = parts.join(F.broadcast(centre.select("column", "centre")), "column")
    spread = off.groupBy("column").agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"))
    asked = F.kll_sketch_get_quantile_double("ranks", F.lit(list(QUARTILES.values())))
    # An empty sketch has no quantiles to ask for: its rows stay out of the expression.
    cuts = centre.where("count > 0").select("column", asked.alias("cuts"))
    joined = centre.drop("ranks").join(F.broadcast(spread), "column").join(F.broadcast(cuts), "column", "left")
    return joined.select(
        "column",
        "count",
        F.col("centre").alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        "min",
        *[F.get("cuts", F.lit(i)).alias(name) for i, name in enumerate(QUARTILES)],
        "max",
        "distinct",
    )
