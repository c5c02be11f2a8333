"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gablework.session import configure, scratch_path, stage

#: White space of the word contract: space, and tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


#: Rows and bytes of whole texts handed to Python at once: one row of any length always fits.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepared(spark: SparkSession) -> SparkSession:
    """The session settings that the operators here rely on."""
    configure(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held(key: str, make: Callable[[], Any]) -> Any:
    """An object made once in a Python worker process; its later tasks find it again."""
    store = sys.modules.setdefault("gablework_held", types.ModuleType("gablework_held")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but :data:`SPACES`; an empty array if none."""
    body = trimmed(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_PATTERN))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns that later expressions refer to by value.

    A plain projection may be merged into the next one; a lambda over arrays
    would then compute its source again for each element.  A generator of one
    row is not merged.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(packed))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged_small(df: DataFrame, label: str) -> DataFrame:
    """As ``stage``, in the densest common compression: for tables of token ids."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_sums(df: DataFrame, order: Sequence[str], **sums: str) -> DataFrame:
    """For each row the sum of a column over all rows before it, in one fixed order.

    The order is that of a hash group, then of ``order``; its sums are taken
    within groups, and the few group totals are summed once.  No task sees more
    than a few groups.  ``sums`` maps a new column to the column summed; rows
    that tie on ``order`` must be interchangeable.
    """
    spark = df.sparkSession
    groups = 4 * partitions(spark)
    keyed = df.withColumn("__group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    within = Window.partitionBy("__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumns({new: F.coalesce(F.sum(old).over(within), F.lit(0)) for new, old in sums.items()})
    totals = keyed.groupBy("__group").agg(*[F.sum(old).alias(f"__total_{new}") for new, old in sums.items()])
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__group",
        *[F.coalesce(F.sum(f"__total_{new}").over(before), F.lit(0)).alias(f"__before_{new}") for new in sums],
    )
    # One row per group: a few thousand at most, by construction.
    joined = local.join(F.broadcast(offsets), "__group")
    done = joined.withColumns({new: F.col(new) + F.col(f"__before_{new}") for new in sums})
    return done.drop("__group", *[f"__before_{new}" for new in sums])


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (node, component) with the smallest node as the name.

    ``edges`` has two columns of one ordered type.  Nodes without an edge to another are not
    listed.  Each round links every node to its smallest smaller neighbour, the other
    smaller neighbours to that one, and then skips one step towards the root, so
    chains halve.  Rounds are written to the shared folder; both sides of every
    join are then plain reads, which lets adaptive execution split a hot hub.
    """
    a, b = edges.columns
    current = stage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("near"))
        .distinct(),
        "edges",
    )
    while True:
        parent = stage(current.groupBy("node").agg(F.min("near").alias("parent")), "parents")
        others = (
            current.join(parent, "node")
            .where(F.col("near") != F.col("parent"))
            .select(F.greatest("near", "parent").alias("node"), F.least("near", "parent").alias("near"), F.lit(1).alias("moved"))
        )
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        skipped = parent.join(above, "parent", "left").select(
            "node", F.coalesce("grand", "parent").alias("near"), F.col("grand").isNotNull().cast("int").alias("moved")
        )
        union = others.unionByName(skipped).groupBy("node", "near").agg(F.max("moved").alias("moved"))
        following = stage(union, "edges")
        moved = following.agg(F.max("moved")).first()[0]
        if not moved:
            return parent.withColumnRenamed("parent", "component")
        current = following.drop("moved")
