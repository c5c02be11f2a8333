"""Tree ensembles as tables: nodes, votes, spreads and nested prefixes.

A saved ensemble is a table of nodes.  What needs the single trees is a join of
rows and leaves; no tree comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gablework.functions.columns import broadcast_if_small, bytes_of, ratio
from gablework.session import scratch_path, stage


def node_table(ensemble: Model) -> DataFrame:
    """(tree, weight, node, prediction, rows, gain, left, right, feature): every node of a fitted ensemble.

    Read from the ensemble's own files in the shared folder.  Children are -1
    at a leaf, as is the feature.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "ensemble")
    ensemble.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.rawCount").alias("rows"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
    )
    weights = F.array(*[F.lit(float(w)) for w in ensemble.treeWeights])
    return nodes.withColumn("weight", F.element_at(weights, F.col("tree") + 1))


def leaf_table(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, value, weight), written out: leaves are numbered from left to right, as node ids rise."""
    order = Window.partitionBy("tree").orderBy("node")
    leaves = nodes.where("left = -1").select(
        "tree", (F.row_number().over(order) - 1).alias("leaf"), F.col("prediction").alias("value"), "weight"
    )
    return stage(leaves, "leaves")


def placed(ensemble: Model, prepared: DataFrame) -> DataFrame:
    """Prepared rows with their prediction, a number of their own and the leaf of every tree, written out."""
    found = ensemble.copy().setLeafCol("_leaves").transform(prepared)
    numbered = found.withColumns({"_leaves": vector_to_array("_leaves"), "_row": F.monotonically_increasing_id()})
    return stage(numbered.drop("features"), "placed")


def votes(rows: DataFrame, leaves: DataFrame, *keep: str) -> DataFrame:
    """(_row, tree, value, weight, ...): what every tree says of every placed row.

    Leaves of a model whose files are small go to all tasks; of a larger one
    they are joined by tree and leaf, and a leaf that holds many rows is split by
    adaptive execution.
    """
    wide = rows.select("_row", *keep, F.posexplode("_leaves").alias("tree", "leaf")).withColumn("leaf", F.col("leaf").cast("int"))
    return wide.join(broadcast_if_small(leaves, leaves), ["tree", "leaf"]).drop("leaf")


#: Leaves up to this size are looked up as arrays; those of a larger model are joined.
LOOKUP_BYTES = 4 * 1024 * 1024


def values_by_leaf(leaves: DataFrame) -> Column:
    """What every leaf says, as one array per tree in a scalar subquery.  For leaves whose files are small."""
    ordered = F.array_sort(F.collect_list(F.struct("leaf", "value")))
    trees = leaves.groupBy("tree").agg(ordered["value"].alias("values"))
    return trees.agg(F.array_sort(F.collect_list(F.struct("tree", "values")))["values"].alias("v")).select("v").scalar()


def spread_of_trees(ensemble: Model, prepared: DataFrame, width: float = 1.96) -> DataFrame:
    """Add the number of trees, their mean and deviation, and the bounds around the prediction.

    The leaves of a small model are looked up within the row; those of a larger one are
    joined to staged rows, and the votes of a row are added up before they move.
    """
    leaves = leaf_table(node_table(ensemble))
    if bytes_of(leaves) <= LOOKUP_BYTES:
        found = ensemble.copy().setLeafCol("_leaves").transform(prepared).drop("features").withColumn("_values", values_by_leaf(leaves))
        # Deviations are taken from the first vote, so that equal votes deviate by nothing.
        said = F.zip_with("_values", vector_to_array("_leaves"), lambda values, leaf: F.get(values, leaf.cast("int")))
        votes_of = found.withColumn("_votes", said).withColumn("_first", F.get("_votes", F.lit(0)))
        apart = votes_of.withColumns(
            {"n_trees": F.size("_votes").cast("bigint"), "_apart": F.transform("_votes", lambda v: v - F.col("_first"))}
        )
        mean = F.aggregate("_apart", F.lit(0.0), lambda a, v: a + v) / F.col("n_trees")
        spread = F.aggregate("_apart", F.lit(0.0), lambda a, v: a + (v - F.col("_mean")) * (v - F.col("_mean")))
        placed_rows = (
            apart.withColumn("_mean", mean)
            .withColumns({"tree_mean": F.col("_first") + F.col("_mean"), "tree_std": F.sqrt(spread / F.col("n_trees"))})
            .drop("_values", "_leaves", "_votes", "_first", "_apart", "_mean")
        )
    else:
        rows = placed(ensemble, prepared)
        stats = votes(rows, leaves).groupBy("_row").agg(
            F.count(F.lit(1)).alias("n_trees"), F.avg("value").alias("tree_mean"), F.stddev_pop("value").alias("tree_std")
        )
        placed_rows = rows.drop("_leaves").join(stats, "_row").drop("_row")
    return placed_rows.withColumns(
        {
            "lower_bound": F.col("prediction") - F.col("tree_std") * width,
            "upper_bound": F.col("prediction") + F.col("tree_std") * width,
        }
    )


def importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): gains weighed by rows, as shares within each tree, then of all trees."""
    gains = nodes.where("left <> -1").groupBy("tree", "weight", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    total = F.sum("gain").over(Window.partitionBy("tree"))
    shares = gains.withColumn("share", ratio(F.col("gain"), total) * F.col("weight"))
    summed = shares.groupBy("feature").agg(F.sum("share").alias("share"))
    # One row per feature: the windows here are as short as the list of features.
    return summed.select("feature", ratio(F.col("share"), F.sum("share").over(Window.partitionBy())).alias("importance"))


def prefix_prediction(size: int, averaged: bool) -> Column:
    """The prediction of the first ``size`` trees as an aggregate of votes: their mean, or their weighted sum."""
    said = F.col("value") if averaged else F.col("value") * F.col("weight")
    total = F.sum(F.when(F.col("tree") < size, said))
    return total / size if averaged else total


def prefix_errors(ensemble: Model, prepared: DataFrame, target: str, sizes: Sequence[int], averaged: bool) -> DataFrame:
    """One row: ``n`` and, for each number of first trees, the mean squared error ``mse_<size>``.

    One pass over the rows' votes serves all sizes.
    """
    rows = placed(ensemble, prepared.select("features", target))
    found = votes(rows, leaf_table(node_table(ensemble)), target)
    per_row = found.groupBy("_row").agg(F.first(target).alias("_wanted"), *[prefix_prediction(s, averaged).alias(f"_p{s}") for s in sizes])
    errors = [F.avg((F.col("_wanted") - F.col(f"_p{s}")) ** 2).alias(f"mse_{s}") for s in sizes]
    return per_row.agg(F.count(F.lit(1)).alias("n"), *errors)
