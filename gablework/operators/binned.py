"""Bagged trees from counts of binned rows.

Spark's trees look at a feature through at most 32 bins.  Rows that agree in all
bins are one row here, with how often each tree's bag holds them and what they cost:
many trees and settings are then fitted without another pass over the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import ratio
from gablework.session import stage

#: Bins of a feature, as Spark's default.
BINS = 32
#: Lets Spark look at a million of the binned rows for the (at most 32) values of a feature, not at 10,000.
LOOK = 1024


def cut_points(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Inner bounds of the bins of each feature, from all rows: between neighbours of few values, else quantiles."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(
        *[F.approx_count_distinct(c).alias(f"n_{c}") for c in features],
        *[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q_{c}") for c in features],
    ).first()
    few = [c for c in features if found[f"n_{c}"] <= 2 * bins]
    # The sets are short: their sizes were estimated before.
    sets = rows.agg(*[F.sort_array(F.collect_set(F.col(c).cast("double"))).alias(c) for c in few]).first() if few else {}
    out = {}
    for c in features:
        values = sets[c] if c in few else None
        if values is not None and len(values) <= bins:
            out[c] = [(a + b) / 2 for a, b in zip(values[:-1], values[1:])]
        else:
            out[c] = sorted(set(found[f"q_{c}"] or []))
    return out


def bags(row_id: str, seed: int, trees: int) -> Column:
    """How often the bag of each tree holds a row, as an array: Poisson of mean 1, by a hash of the row's id."""
    chances = [math.exp(-1) / math.factorial(k) for k in range(16)]
    bounds = [math.fsum(chances[: k + 1]) for k in range(16)]

    def count(place: Column) -> Column:
        found = F.when(place < bounds[0], 0)
        for k, bound in enumerate(bounds[1:], 1):
            found = found.when(place < bound, k)
        return found.otherwise(len(bounds))

    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    places = F.transform(numbers, lambda t: F.shiftrightunsigned(F.xxhash64(F.col(row_id), F.lit(seed), t), 11) * F.lit(2.0**-53))
    return F.transform(places, count)


def bag_counts(row_id: str, seed: int, trees: int) -> list[Column]:
    """:func:`bags` as a column per tree."""
    return [bags(row_id, seed, trees)[t] for t in range(trees)]


def binned(rows: DataFrame, features: Sequence[str], target: str, row_id: str, trees: int, seed: int, *keep: str) -> DataFrame:
    """(bins, n, sum, squares, w, s, row, ...) per set of bins and ``keep``, written out.

    ``row`` is a number of its own; ``n``, ``sum`` and ``squares`` are of the target over the rows themselves, ``w``
    and ``s`` the rows and the target's sum in each tree's bag.
    """
    # Codes of categories stay as they are: trees part them in any order.
    codes = {c for c in features if rows.schema[c].metadata.get("ml_attr", {}).get("type") == "nominal"}
    scaled = [c for c in features if c not in codes]
    cuts = cut_points(rows, scaled)
    names = [f"_b_{c}" for c in features]
    # A bucketizer wants one bound at least; a bin without rows does no harm.
    splits = [[-math.inf, *(cuts[c] or [0.0]), math.inf] for c in scaled]
    placed = Bucketizer(splitsArray=splits, inputCols=scaled, outputCols=[f"_b_{c}" for c in scaled]).transform(rows)
    placed = placed.withColumns({f"_b_{c}": F.col(c) for c in codes})
    drawn = placed.select(*keep, *names, F.col(target).cast("double").alias("_y"), bags(row_id, seed, trees).alias("_w"))
    summed = drawn.groupBy(*keep, *names).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_y").alias("sum"),
        F.sum(F.col("_y") * F.col("_y")).alias("squares"),
        F.array(*[F.sum(F.col("_w")[t]).cast("double") for t in range(trees)]).alias("w"),
        F.array(*[F.sum(F.col("_w")[t] * F.col("_y")) for t in range(trees)]).alias("s"),
    )
    # Bins have an order, which a bucketizer's own description of its output would deny.
    ordered = summed.withColumns({f"_b_{c}": F.col(f"_b_{c}").alias(f"_b_{c}", metadata={}) for c in scaled})
    vectors = VectorAssembler(inputCols=names, outputCol="bins").transform(ordered)
    own = F.monotonically_increasing_id().alias("row")
    return stage(vectors.select(*keep, "bins", "n", "sum", "squares", "w", "s", own), "binned")


def bag_sizes(table: DataFrame, trees: int, by: str) -> dict[int, list[float]]:
    """Rows in the bag of each tree, per value of a column with few values."""
    sizes = table.groupBy(by).agg(F.array(*[F.sum(F.col("w")[t]) for t in range(trees)]).alias("sizes"))
    return {r[by]: r["sizes"] for r in sizes.collect()}


def fit_tree(table: DataFrame, tree: int, total: float, depth: int, least: int, strategy: str, seed: int) -> RandomForestRegressionModel:
    """One tree of a forest on its bag of ``total`` rows: bins of equal rows weigh as many rows as the bag holds.

    Rows that agree in all bins never part, so their spread changes no gain and their mean stands for them.
    ``least`` is in rows of the bag, as it is for rows one by one.
    """
    own = table.select("bins", F.col("w")[tree].alias("weight"), F.col("s")[tree].alias("_s")).where("weight > 0")
    one = RandomForestRegressor(
        featuresCol="bins",
        labelCol="label",
        weightCol="weight",
        predictionCol=f"_t{tree}",
        numTrees=1,
        bootstrap=False,
        # Too few rows for two leaves: none is split.
        maxDepth=depth if total >= 2 * least else 0,
        minWeightFractionPerNode=(least - 0.5) / total if total >= 2 * least and least > 1 else 0.0,
        featureSubsetStrategy=strategy,
        maxBins=LOOK,
        seed=seed + tree,
    )
    return one.fit(own.select("bins", "weight", (F.col("_s") / F.col("weight")).alias("label")))


def prefix_errors(trees: Sequence[RandomForestRegressionModel], table: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """One row: ``n`` and, for each number of first trees, the mean squared error ``mse_<size>`` over all rows of the table."""
    for tree in trees:
        table = tree.transform(table)
    errors = []
    for size in sizes:
        said = sum((F.col(f"_t{t}") for t in range(1, size)), F.col("_t0")) / size
        lost = F.col("n") * said * said - 2 * said * F.col("sum") + F.col("squares")
        errors.append(ratio(F.sum(lost), F.sum("n").cast("double")).alias(f"mse_{size}"))
    return table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *errors)
