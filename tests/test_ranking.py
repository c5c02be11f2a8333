import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.operators.ranking import cumulate, number_rows, quantiles, smallest_hash_cut
from gablework.operators.splits import digest, split_exact


def skewed(n, seed):
    rng = random.Random(seed)
    # a third of the rows share one value, the rest spans many magnitudes
    return [0.5 if rng.random() < 0.34 else math.exp(rng.gauss(0, 8)) * rng.choice([-1, 1]) for _ in range(n)]


@pytest.mark.parametrize("n,seed", [(1, 1), (2, 2), (7, 3), (1000, 4), (5003, 5)])
def test_quantiles_equal_numpy(spark, n, seed):
    values = skewed(n, seed)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    row = quantiles(df, ["v"], probs).first()
    assert row["n"] == n
    for p in probs:
        name = "p" + f"{p * 100:g}"
        assert row[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-300)


def test_quantiles_skip_missing_and_keep_groups(spark):
    rows = [("x", 1.0), ("x", float("nan")), ("x", None), ("x", 4.0), ("y", 2.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: (r["n"], r["p50"]) for r in quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert found == {"x": (2, 2.5), "y": (1, 2.0)}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles(df, ["v"], [0.5]).count() == 0


def test_cumulate_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice("abc"), rng.randrange(400)) for _ in range(3000)]
    counted = spark.createDataFrame(rows, "g string, v int").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    for r in cumulate(counted, "v", ["n"], ["g"], slots=16).collect():
        assert r["cum_n"] == sum(1 for g, v in rows if g == r["g"] and v <= r["v"])
        assert r["total_n"] == sum(1 for g, v in rows if g == r["g"])


def test_number_rows_orders_text_and_ties(spark):
    rows = [(f"name{i % 50:03d}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, i int")
    got = {(r["s"], r["i"]): r["rank"] for r in number_rows(df, [F.col("s"), -F.col("i")]).collect()}
    want = sorted(rows, key=lambda r: (r[0], -r[1]))
    assert [got[r] for r in want] == list(range(1, 501))


@pytest.mark.parametrize("n,k", [(1, 1), (10, 3), (997, 200)])
def test_hash_cut_takes_exactly_k(spark, n, k):
    df = spark.range(n)
    hexes = digest("id")
    cut = smallest_hash_cut(df, hexes, F.lit(k))
    assert df.where(hexes <= cut).count() == k


def test_exact_split_counts(spark):
    parts = split_exact(spark.range(101), "id", 0.2).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == {"test": 21, "train": 80}


def test_exact_split_of_nothing(spark):
    assert split_exact(spark.range(5), "id", 0.0).where("split = 'test'").count() == 0


def test_counting_shuffle_is_reused(spark):
    """The input of a quantile is read once; later uses read its shuffle."""
    df = spark.range(20000).select((F.col("id") % 977).cast("double").alias("v"))
    q = quantiles(df, ["v"], [0.5])
    q.collect()
    assert "ReusedExchange" in q._jdf.queryExecution().executedPlan().toString()
