"""The two derived frames of the test tables: listings and serving log.

Both are given twice, as Spark plans and as DuckDB text for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gablework.functions.columns import broadcast_if_small, num
from gablework.operators.features import rule_price
from gablework.roles import DISTRICT_FACTORS, PRICE_FLOOR, PRICE_WEIGHTS_V1
from gablework.session import spread


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file footers once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _listing_id() -> Column:
    parts = (
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.col("l_quantity").cast("int"),
    )
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """House listings made of the star join around ``lineitem``.

    The dimensions are joined to the narrow orders first, so that ``lineitem``
    is moved once per large join.  File sizes decide what is broadcast; a hot
    key in the shuffled joins is split by the adaptive skew handling.
    """
    line = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")

    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    place = broadcast_if_small(place.select("c_custkey", "r_name"), customer, nation, region)
    sold = orders.join(place, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name")
    sold = broadcast_if_small(sold, orders, customer, nation, region)
    joined = line.join(sold, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    base = joined.select(
        _listing_id().alias("listing_id"),
        (F.col("l_quantity") * 5.0 + 20.0).alias("area"),
        (1 + F.col("p_size") % 5).alias("bedrooms"),
        (1 + F.col("l_linenumber") % 4).alias("bathrooms"),
        (
            (2005 - F.year("l_shipdate")).cast("double") + F.month("l_shipdate").cast("double") / num(12)
        ).alias("age_years"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("has_garage"),
        F.col("r_name").alias("district"),
        F.col("l_shipdate").alias("listed_on"),
        F.col("l_extendedprice").alias("_shift"),
    )
    priced = base.withColumn("predicted", rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=PRICE_FLOOR))
    shifted = F.col("predicted") + (F.col("_shift") - 53000.0) * 2.0
    return priced.withColumn("price", F.greatest(shifted, num(PRICE_FLOOR))).drop("_shift")


def gappy_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with missing values: area, age and district, a sixteenth each."""
    first = F.substring("listing_id", 1, 1)
    return (
        listings(spark, sf_dir)
        .withColumn("area", F.when(first != "0", F.col("area")))
        .withColumn("age_years", F.when(first != "1", F.col("age_years")))
        .withColumn("district", F.when(first != "2", F.col("district")))
    )


def serving_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests against a served model, read from ``events``."""
    return to_serving_log(table(spark, sf_dir, "events"))


def to_serving_log(events: DataFrame) -> DataFrame:
    user = F.md5(F.col("user_id").cast("string"))
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.substring(user, 1, 1) < "2", "canary").otherwise("stable").alias("variant"),
        F.when(F.substring(user, 1, 1) < "8", "A").otherwise("B").alias("arm"),
        F.col("value").alias("response_time"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
    )


LISTINGS_SQL = """
listings0 AS (
  SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
             CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
             CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS VARCHAR),
             CAST(CAST(l_quantity AS INT) AS VARCHAR))) AS listing_id,
         l_quantity*5e0 + 20e0 AS area,
         1 + p_size % 5 AS bedrooms,
         1 + l_linenumber % 4 AS bathrooms,
         CAST(2005 - year(l_shipdate) AS DOUBLE) + CAST(month(l_shipdate) AS DOUBLE)/12e0 AS age_years,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS has_garage,
         r_name AS district,
         l_shipdate AS listed_on,
         CASE r_name WHEN 'AFRICA' THEN 1.2e0 WHEN 'AMERICA' THEN 1.5e0 WHEN 'ASIA' THEN 0.9e0
              WHEN 'EUROPE' THEN 1e0 ELSE 0.8e0 END AS multiplier,
         l_extendedprice AS shift
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
listings1 AS (
  SELECT *, greatest((2000e0*area + 50000e0*bedrooms + 30000e0*bathrooms - 5000e0*age_years
                      + 25000e0*has_garage)*multiplier, 50000e0) AS predicted FROM listings0),
listings AS (
  SELECT *, greatest(predicted + (shift - 53000e0)*2e0, 50000e0) AS price FROM listings1)
"""

GAPPY_SQL = (
    LISTINGS_SQL
    + """,
gappy AS (
  SELECT * REPLACE (CASE WHEN substr(listing_id,1,1) <> '0' THEN area END AS area,
                    CASE WHEN substr(listing_id,1,1) <> '1' THEN age_years END AS age_years,
                    CASE WHEN substr(listing_id,1,1) <> '2' THEN district END AS district)
  FROM listings)
"""
)

SERVING_SQL = """
serving AS (
  SELECT event_id, ts, user_id,
         CASE WHEN substr(md5(CAST(user_id AS VARCHAR)),1,1) < '2' THEN 'canary' ELSE 'stable' END AS variant,
         CASE WHEN substr(md5(CAST(user_id AS VARCHAR)),1,1) < '8' THEN 'A' ELSE 'B' END AS arm,
         value AS response_time,
         CAST(event_type = 'error' AS INT) AS is_error
  FROM events)
"""
