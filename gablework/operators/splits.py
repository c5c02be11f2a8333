"""Reproducible splits, folds, nested samples and traffic shares.

All are decided row by row from a digest of the row id, so they need no
shuffle, survive recomputation and do not depend on how the data is laid out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.columns import broadcast_if_small
from gablework.operators.ranking import cumulate, smallest_hash_cut
from gablework.session import stage


def digest(row_id: str | Column, salt: str | int = 42) -> Column:
    column = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat_ws("|", column.cast("string"), F.lit(str(salt))))


def below_share(hexes: Column, fraction: float) -> Column:
    """Whether a digest falls into the first ``fraction`` of the digest space."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(hexes, 1, 8) < f"{int(round(max(fraction, 0) * 16**8)):08x}"


def split_by_share(df: DataFrame, row_id: str, test_size: float = 0.2, salt: str | int = 42) -> DataFrame:
    """Add ``split``: test rows are about ``test_size`` of all.  No pass over the data."""
    test = below_share(digest(row_id, salt), test_size)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_exact(df: DataFrame, row_id: str, test_size: float = 0.2, salt: str | int = 42) -> DataFrame:
    """Add ``split`` with exactly ``ceil(n * test_size)`` test rows.

    Needs unique row ids.  The cut is found from histograms of the digests;
    the rows are only filtered.
    """
    hexes = digest(row_id, salt)
    cut = smallest_hash_cut(df, hexes, F.ceil(F.col("total") * float(test_size)))
    test = F.coalesce(hexes <= cut, F.lit(False))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_three_ways(
    df: DataFrame,
    row_id: str,
    test_size: float = 0.2,
    validation_size: float = 0.2,
    salts: tuple[str | int, str | int] = (42, 43),
    exact: bool = False,
) -> DataFrame:
    """Add ``split`` with values train, validation and test.

    ``validation_size`` is the share of what the test rows leave.
    """
    if not exact:
        test = below_share(digest(row_id, salts[0]), test_size)
        validation = below_share(digest(row_id, salts[1]), validation_size)
    else:
        first, second = digest(row_id, salts[0]), digest(row_id, salts[1])
        cut = smallest_hash_cut(df, first, F.ceil(F.col("total") * float(test_size)))
        rest = df.where(~F.coalesce(first <= cut, F.lit(False)))
        cut2 = smallest_hash_cut(rest, second, F.ceil(F.col("total") * float(validation_size)))
        test = F.coalesce(first <= cut, F.lit(False))
        validation = F.coalesce(second <= cut2, F.lit(False))
    return df.withColumn("split", F.when(test, "test").when(validation, "validation").otherwise("train"))


def split_profile(df: DataFrame, target: str, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
    )


def with_fold(df: DataFrame, row_id: str, k: int = 5, salt: str | int = 42, column: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1, shuffled by the digest of the id."""
    number = F.conv(F.substring(digest(row_id, salt), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(column, F.pmod(number, F.lit(k)).cast("int"))


def with_positions(scan: DataFrame, column: str = "position") -> tuple[DataFrame, int]:
    """Number the rows of a parquet scan from 0 in the order of file name and place in the file; and their count.

    The place in a file is known to the reader, and the files' row counts are
    summed up range by range: rows are neither sorted nor moved.  ``scan``
    must be a plain read of parquet files.
    """
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    # A row per file that holds rows.
    files = stage(placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")), "files")
    starts = stage(
        cumulate(files, "_file", ["_rows"]).select("_file", (F.col("cum__rows") - F.col("_rows")).alias("_start")), "file-starts"
    )
    total = files.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()["n"]
    numbered = placed.join(broadcast_if_small(starts, starts), "_file")
    return numbered.withColumn(column, F.col("_start") + F.col("_place")).drop("_file", "_place", "_start"), int(total)


def with_contiguous_fold(scan: DataFrame, k: int = 5, column: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1: consecutive rows, the first ``n % k`` folds one row longer than the others.

    For a plain read of parquet files, in the order of :func:`with_positions`.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")
    numbered, n = with_positions(scan, "_position")
    if n < k:
        raise ValueError(f"{k} folds of {n} rows")
    size, longer = divmod(n, k)
    at = F.col("_position")
    in_longer = F.floor(at / F.lit(size + 1))
    after = F.lit(longer) + F.floor((at - F.lit(longer * (size + 1))) / F.lit(size))
    fold = F.when(at < longer * (size + 1), in_longer).otherwise(after)
    return numbered.withColumn(column, fold.cast("int")).drop("_position")


def nested_samples(
    df: DataFrame, row_id: str, fractions: Sequence[float] | None = None, salt: str | int = 42
) -> DataFrame:
    """Add ``smallest_sample``: the 1-based index of the first sample a row is in.

    Sample i consists of the rows whose index is at most i, so every sample
    contains the ones before it and the data is kept once.
    """
    fractions = list(fractions or [i / 10 for i in range(1, 11)])
    hexes = digest(row_id, salt)
    index = F.lit(None).cast("int")
    for i in range(len(fractions), 0, -1):
        index = F.when(below_share(hexes, fractions[i - 1]), i).otherwise(index)
    return df.withColumn("smallest_sample", index)


def assign_traffic(df: DataFrame, user: str, shares: dict[str, float], column: str = "arm") -> DataFrame:
    """A sticky arm per user; ``shares`` add up to 1, the last arm takes the rest."""
    hexes = F.md5(F.col(user).cast("string"))
    arms = list(shares)
    assigned = F.lit(arms[-1])
    edge = sum(shares[a] for a in arms[:-1])
    for arm in reversed(arms[:-1]):
        assigned = F.when(below_share(hexes, edge), arm).otherwise(assigned)
        edge -= shares[arm]
    return df.withColumn(column, assigned)
