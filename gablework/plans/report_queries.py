"""Registered queries: profiling, ranking, evaluation, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gablework.functions.columns import ratio, to_long
from gablework.functions.metrics import core_metrics, named, r2, rmse
from gablework.operators import evaluate as E
from gablework.operators import features as P
from gablework.operators import gates as G
from gablework.operators import increments as I
from gablework.operators import profile as A
from gablework.operators import quality as Q
from gablework.operators import robustness as B
from gablework.operators import splits as L
from gablework.operators.ranking import number_rows
from gablework.plans.data_queries import CORE_SQL, NUMERIC, RANGE_WHERE, RAW, SPLIT_SQL, staged
from gablework.plans.listings import GAPPY_SQL, LISTINGS_SQL, gappy_listings, listings, table
from gablework.plans.registry import register
from gablework.roles import (
    DISTRICT_FACTORS,
    EDGE_ROWS,
    EDGE_ROWS_WIDE,
    PRICE_WEIGHTS_V1,
    PRICE_WEIGHTS_V2,
    QUALITY_GATES,
    RANGE_RULES,
)
from gablework.session import scratch_path, stage
from gablework.sources.manifest import Store

# --- flagship --------------------------------------------------------------


def flagship(spark, d) -> DataFrame:
    """Clean, derive features, evaluate the rule price per district: one shuffle after the joins."""
    clean = P.derive_features(Q.clean_by_rules(listings(spark, d), RANGE_RULES))
    metrics = core_metrics()
    return clean.groupBy("district").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("area_per_room").alias("mean_area_per_room"),
        F.avg("bathroom_ratio").alias("mean_bathroom_ratio"),
        *named(metrics, "rmse", "mae", "r2", "mape"),
    )


register(
    "flagship_district_report",
    flagship,
    LISTINGS_SQL,
    f"""SELECT district, n, mean_area_per_room, mean_bathroom_ratio, rmse, mae, r2, mape FROM (
  SELECT district, avg(area/(bedrooms+1)) AS mean_area_per_room, avg(bathrooms*1e0/bedrooms) AS mean_bathroom_ratio,
  {CORE_SQL} FROM listings WHERE {RANGE_WHERE} GROUP BY district)""",
    mean_area_per_room=6,
    mean_bathroom_ratio=6,
    rmse=3,
    mae=3,
    r2=8,
    mape=6,
)

# --- profiling -------------------------------------------------------------


def _describe_sql(c: str, source: str = "gappy") -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont({c}*1e0, 0.25) AS p25,
  quantile_cont({c}*1e0, 0.5) AS p50, quantile_cont({c}*1e0, 0.75) AS p75 FROM {source}"""


register(
    "a1_describe",
    lambda spark, d: A.describe(stage(gappy_listings(spark, d)), NUMERIC),
    GAPPY_SQL,
    " UNION ALL ".join(_describe_sql(c) for c in NUMERIC),
    mean=4,
    std=4,
    min=4,
    max=4,
    p25=4,
    p50=4,
    p75=4,
)


def _merged_profile(spark, d) -> DataFrame:
    """Folders per district profiled in two runs, the second without the first one's folders; merged from states.

    Quartiles are shown by whether their exact rank lies within the stated bound.
    """
    rows, root = stage(gappy_listings(spark, d)), scratch_path(spark, "folders")
    place = F.coalesce("district", F.lit("none"))
    rows.select(*NUMERIC, place.alias("place")).write.partitionBy("place").parquet(root)
    # A handful of districts.
    folders = sorted(f"{root}/place={r[0]}" for r in rows.select(place).distinct().collect())
    store = Store(spark, scratch_path(spark, "profiles"))
    for known in (folders[:2], folders):
        I.add_folders(store, known, NUMERIC)
    merged = stage(I.merged_profile(store.read()), "merged")
    # One row per column; its quartiles steer the second pass as literals.
    cuts = {r["column"]: r for r in merged.collect()}
    ranks = rows.agg(
        *[
            F.struct(F.avg((F.col(c) < cuts[c][q]).cast("int")).alias("below"), F.avg((F.col(c) <= cuts[c][q]).cast("int")).alias("upto")).alias(f"{q}_{c}")
            for c in NUMERIC
            for q in I.QUARTILES
        ]
    )
    long = to_long(ranks, list(NUMERIC), {q: f"{q}_{{}}" for q in I.QUARTILES})
    near = F.lit(True)
    for q, p in I.QUARTILES.items():
        near = near & (F.col(f"{q}.below") - I.rank_error() <= p) & (F.col(f"{q}.upto") + I.rank_error() >= p)
    return merged.select("column", "count", "mean", "std", "min", "max").join(
        F.broadcast(long.select("column", near.alias("quartiles_within_bound"))), "column"
    )


register(
    "a1_merged_profile",
    _merged_profile,
    GAPPY_SQL,
    'SELECT "column", "count", mean, std, min, max, true AS quartiles_within_bound FROM ('
    + " UNION ALL ".join(_describe_sql(c) for c in NUMERIC)
    + ")",
    mean=4,
    std=4,
    min=4,
    max=4,
)
register(
    "a2_shape_report",
    lambda spark, d: A.shape_report(listings(spark, d).select(*RAW)),
    LISTINGS_SQL,
    """SELECT CAST(i - 1 AS INT) AS position, ['area','bedrooms','bathrooms','age_years','has_garage','district','price'][i] AS "column",
  ['double','int','int','double','int','string','double'][i] AS type, (SELECT count(*) FROM listings) AS rows,
  CAST(7 AS INT) AS columns FROM range(1, 8) t(i)""",
)
for _column in ("district", "bedrooms", "bathrooms", "has_garage"):
    register(
        f"a3_value_counts_{_column}",
        lambda spark, d, c=_column: A.value_counts(listings(spark, d), c),
        LISTINGS_SQL,
        f"""SELECT {_column}, count(*) AS n, round(count(*)*100e0/(SELECT count(*) FROM listings), 2) AS percent
  FROM listings GROUP BY {_column}""",
    )
register(
    "a4_group_statistics",
    lambda spark, d: A.group_stats(
        staged(spark, d), "district", "price", ["area", "bedrooms", "bathrooms", "age_years", "has_garage"]
    ),
    LISTINGS_SQL,
    """SELECT district, count(price) AS n, round(avg(price), 2) AS mean, round(stddev_samp(price), 2) AS std,
  round(min(price), 2) AS min, round(max(price), 2) AS max, round(avg(area), 2) AS mean_area,
  round(avg(bedrooms), 2) AS mean_bedrooms, round(avg(bathrooms), 2) AS mean_bathrooms,
  round(avg(age_years), 2) AS mean_age_years, round(avg(has_garage), 2) AS mean_has_garage,
  round(quantile_cont(price, 0.5), 2) AS median FROM listings GROUP BY district""",
)
register(
    "a5_group_ranking",
    lambda spark, d: A.group_ranking(listings(spark, d), "district", "price"),
    LISTINGS_SQL,
    """SELECT district, mean, CAST(row_number() OVER (ORDER BY mean DESC, district) AS INT) AS rank
  FROM (SELECT district, avg(price) AS mean FROM listings GROUP BY district)""",
    mean=3,
)
register(
    "a6_group_share",
    lambda spark, d: A.group_share(listings(spark, d), "district", "has_garage"),
    LISTINGS_SQL,
    "SELECT district, avg(has_garage)*100e0 AS percent FROM listings GROUP BY district",
    percent=8,
)
_TARGET_SQL = """SELECT avg(price) AS mean, quantile_cont(price, 0.5) AS median, stddev_samp(price) AS std,
  min(price) AS min, max(price) AS max, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3,
  stddev_samp(price)/avg(price)*100e0 AS variation_percent FROM listings"""
register(
    "a7_target_summary",
    lambda spark, d: A.target_summary(staged(spark, d), "price").drop("variation_percent"),
    LISTINGS_SQL,
    f"SELECT * EXCLUDE (variation_percent) FROM ({_TARGET_SQL})",
    mean=3,
    median=3,
    std=3,
    min=3,
    max=3,
    q1=3,
    q3=3,
)
register(
    "a8_variation",
    lambda spark, d: listings(spark, d).agg(
        (ratio(F.stddev_samp("price"), F.avg("price")) * 100.0).alias("variation_percent")
    ),
    LISTINGS_SQL,
    "SELECT stddev_samp(price)/avg(price)*100e0 AS variation_percent FROM listings",
    variation_percent=8,
)
register(
    "a9_correlation_matrix",
    lambda spark, d: A.correlation_matrix(listings(spark, d), NUMERIC),
    LISTINGS_SQL,
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM listings"
        for a in NUMERIC
        for b in NUMERIC
    ),
    correlation=8,
)
_EXTRA = {
    "area_per_room": "area/(bedrooms+1)",
    "bathroom_ratio": "bathrooms*1e0/bedrooms",
    "age_squared": "age_years*age_years",
    "total_rooms": "bedrooms+bathrooms",
}
_RANKED = ["area", "bedrooms", "bathrooms", "age_years", "has_garage", *_EXTRA]
register(
    "a10_correlation_ranking",
    lambda spark, d: A.correlation_ranking(P.derive_features(listings(spark, d)), "price", _RANKED),
    LISTINGS_SQL
    + ", corrs AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", corr({_EXTRA.get(c, c)}, price) AS correlation FROM listings" for c in _RANKED
    )
    + ")",
    """SELECT "column", correlation, CASE WHEN abs(correlation) > 0.7e0 THEN 'strong'
  WHEN abs(correlation) > 0.3e0 THEN 'moderate' ELSE 'weak' END AS strength,
  CASE WHEN correlation > 0 THEN 'positive' ELSE 'negative' END AS direction,
  CAST(row_number() OVER (ORDER BY abs(correlation) DESC, "column") AS INT) AS rank FROM corrs""",
    correlation=8,
)


def _histogram_sql(value: str, source: str, bins: int = 30) -> str:
    return f"""SELECT CAST(b AS INT) AS bin, lo + b*((hi-lo)/{bins}) AS lower, lo + (b+1)*((hi-lo)/{bins}) AS upper,
  count(v) AS n FROM range(0, {bins}) t(b) CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source})
  LEFT JOIN (SELECT {value} AS v, least(floor(({value} - (SELECT min({value}) FROM {source}))
     / (((SELECT max({value}) FROM {source}) - (SELECT min({value}) FROM {source}))/{bins})), {bins - 1}) AS place FROM {source})
  ON place = b GROUP BY ALL"""


register(
    "a11_histogram",
    lambda spark, d: A.histogram(staged(spark, d), F.col("price")),
    LISTINGS_SQL,
    _histogram_sql("price", "listings"),
    lower=3,
    upper=3,
)


def _box_sql(by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, max(q1) AS q1, max(median) AS median, max(q3) AS q3,
  min(price) FILTER (WHERE price BETWEEN q1-1.5e0*(q3-q1) AND q3+1.5e0*(q3-q1)) AS whisker_low,
  max(price) FILTER (WHERE price BETWEEN q1-1.5e0*(q3-q1) AND q3+1.5e0*(q3-q1)) AS whisker_high,
  count(*) FILTER (WHERE NOT price BETWEEN q1-1.5e0*(q3-q1) AND q3+1.5e0*(q3-q1)) AS outliers
  FROM listings JOIN (SELECT {by}, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
     quantile_cont(price, 0.75) AS q3 FROM listings GROUP BY {by}) USING ({by}) GROUP BY {by}"""


for _column in ("district", "bedrooms"):
    register(
        f"a12_box_table_{_column}",
        lambda spark, d, c=_column: A.box_table(listings(spark, d), c, "price"),
        LISTINGS_SQL,
        _box_sql(_column),
        q1=3,
        median=3,
        q3=3,
        whisker_low=3,
        whisker_high=3,
    )
register(
    "a13_distinct_counts",
    lambda spark, d: A.distinct_counts(gappy_listings(spark, d), NUMERIC),
    GAPPY_SQL,
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) > 10 AS continuous FROM gappy"
        for c in NUMERIC
    ),
)
register(
    "a14_category_listing",
    lambda spark, d: A.category_listing(listings(spark, d), "district"),
    LISTINGS_SQL,
    """SELECT DISTINCT district AS category, (SELECT count(DISTINCT district) FROM listings) AS total_count FROM listings""",
)
register(
    "a15_mean_and_spread",
    lambda spark, d: A.mean_and_spread(listings(spark, d), NUMERIC),
    LISTINGS_SQL,
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg({c}) AS mean, stddev_samp({c}) AS std FROM listings" for c in NUMERIC
    ),
    mean=4,
    std=4,
)

# --- ranking, order, set operations ----------------------------------------

register(
    "w1_rank_enumeration",
    lambda spark, d: number_rows(
        table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity")),
        [-F.col("quantity"), F.col("l_suppkey")],
    ),
    None,
    """SELECT l_suppkey, quantity, CAST(row_number() OVER (ORDER BY quantity DESC, l_suppkey) AS INT) AS rank
  FROM (SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey)""",
    quantity=3,
)


def _ecdf(spark, d):
    from gablework.operators.ranking import cumulate

    counted = listings(spark, d).groupBy("district", "age_years").agg(F.count(F.lit(1)).alias("n"))
    ranked = cumulate(counted, "age_years", ["n"], ["district"])
    return ranked.select("district", "age_years", (F.col("cum_n") / F.col("total_n")).alias("share"))


register(
    "w2_ecdf",
    _ecdf,
    LISTINGS_SQL,
    """SELECT district, age_years, sum(n) OVER (PARTITION BY district ORDER BY age_years)*1e0
   / sum(n) OVER (PARTITION BY district) AS share
  FROM (SELECT district, age_years, count(*) AS n FROM listings GROUP BY ALL)""",
    age_years=6,
    share=8,
)
register(
    "w3_sort_by_size",
    lambda spark, d: E.evaluate(listings(spark, d), ["district"]).select(
        "district", (F.col("mae") - 52_000.0).alias("excess")
    ).orderBy(F.abs("excess").desc()),
    LISTINGS_SQL,
    "SELECT district, avg(abs(price-predicted)) - 52000e0 AS excess FROM listings GROUP BY district ORDER BY abs(excess) DESC",
    excess=3,
)
register(
    "w4_top_k",
    lambda spark, d: A.head(listings(spark, d).select("listing_id", "price"), [F.col("price").desc(), "listing_id"], 5),
    LISTINGS_SQL,
    "SELECT listing_id, price FROM listings ORDER BY price DESC, listing_id LIMIT 5",
    price=6,
)
register(
    "w5_head_and_tail",
    lambda spark, d: A.head(listings(spark, d).select("listing_id", "area"), ["listing_id"]).withColumn(
        "part", F.lit("head")
    ).unionByName(
        A.tail(listings(spark, d).select("listing_id", "area"), ["listing_id"]).withColumn("part", F.lit("tail"))
    ),
    LISTINGS_SQL,
    """(SELECT listing_id, area, 'head' AS part FROM listings ORDER BY listing_id LIMIT 5)
  UNION ALL (SELECT listing_id, area, 'tail' AS part FROM listings ORDER BY listing_id DESC LIMIT 5)""",
    area=6,
)


def _append(spark, d):
    events = table(spark, d, "events").select("event_type", "value")
    errors, others = events.where("event_type = 'error'"), events.where("event_type <> 'error'")
    return errors.unionByName(others).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


register(
    "w6_append_samples",
    _append,
    None,
    "SELECT event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY event_type",
    mean=6,
)
register(
    "w7_set_difference",
    lambda spark, d: table(spark, d, "documents").select("doc_id").join(
        table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti"
    ),
    None,
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
register(
    "w8_standardised_residuals",
    lambda spark, d: A.standardised_residuals(staged(spark, d), "listing_id", "price", "predicted"),
    LISTINGS_SQL,
    """SELECT listing_id, price - predicted AS residual,
  (price - predicted)/(SELECT stddev_samp(price - predicted) FROM listings) AS standardised FROM listings""",
    residual=4,
    standardised=6,
)
register(
    "w9_normal_plot",
    lambda spark, d: A.normal_plot(listings(spark, d), F.round(F.col("price") - F.col("predicted"), 4)).drop(
        "first_quantile", "last_quantile"
    ),
    LISTINGS_SQL,
    """SELECT value, count(*) AS n, min(r) AS first_rank, max(r) AS last_rank FROM (
  SELECT value, row_number() OVER (ORDER BY value) AS r FROM
    (SELECT round(price - predicted, 4) + 0e0 AS value FROM listings)) GROUP BY value""",
    value=4,
)
register(
    "w9_normal_plot_quantiles",
    lambda spark, d: A.normal_plot(listings(spark, d), F.round(F.col("price") - F.col("predicted"), 4)),
    value=4,
    first_quantile=9,
    last_quantile=9,
)

# --- evaluation ------------------------------------------------------------

register(
    "e1_e2_core_metrics",
    lambda spark, d: E.evaluate(listings(spark, d)),
    LISTINGS_SQL,
    f"SELECT {CORE_SQL} FROM listings",
    mse=0,
    rmse=3,
    mae=3,
    r2=8,
    mape=6,
)
register(
    "e1_e2_core_metrics_by_district",
    lambda spark, d: E.evaluate(listings(spark, d), ["district"]),
    LISTINGS_SQL,
    f"SELECT district, {CORE_SQL} FROM listings GROUP BY district",
    mse=0,
    rmse=3,
    mae=3,
    r2=8,
    mape=6,
)
register(
    "e3_error_extremes",
    lambda spark, d: E.error_extremes(staged(spark, d)),
    LISTINGS_SQL,
    """SELECT quantile_cont(abs(price-predicted), 0.5) AS median_absolute_error, max(abs(price-predicted)) AS max_error,
  1e0 - var_pop(price-predicted)/var_pop(price) AS explained_variance FROM listings""",
    median_absolute_error=3,
    max_error=3,
    explained_variance=8,
)

_MOMENTS_SQL = (
    LISTINGS_SQL
    + """,
res AS (SELECT price-predicted AS r FROM listings),
mom AS (SELECT count(*) AS n, avg(r) AS mean, stddev_samp(r) AS std, kurtosis_pop(r) AS kurtosis, var_pop(r) AS v FROM res),
skew AS (SELECT avg((r-mean)*(r-mean)*(r-mean))/(max(v)*sqrt(max(v))) AS skewness FROM res, mom)"""
)
register(
    "e4_residual_moments",
    lambda spark, d: E.residual_moments(listings(spark, d)).drop("normality_p"),
    _MOMENTS_SQL,
    "SELECT n, mean, std, skewness, kurtosis FROM mom, skew",
    mean=3,
    std=3,
    skewness=7,
    kurtosis=7,
)
_K2_SQL = (
    _MOMENTS_SQL
    + """,
k1 AS (SELECT n*1e0 AS n, skewness AS g, kurtosis + 3e0 AS b2 FROM mom, skew),
k2 AS (SELECT *, g*sqrt((n+1)*(n+3)/(6e0*(n-2))) AS y,
  3e0*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) AS beta, 3e0*(n-1)/(n+1) AS e,
  24e0*n*(n-2)*(n-3)/((n+1)*(n+1)*(n+3)*(n+5)) AS var,
  6e0*(n*n-5*n+2)/((n+7)*(n+9))*sqrt(6e0*(n+3)*(n+5)/(n*(n-2)*(n-3))) AS s FROM k1),
k3 AS (SELECT *, sqrt(2e0*(beta-1))-1 AS w2, (b2-e)/sqrt(var) AS x, 6e0+8e0/s*(2e0/s+sqrt(1e0+4e0/(s*s))) AS a FROM k2),
k4 AS (SELECT asinh(y/sqrt(2e0/(w2-1)))/sqrt(0.5e0*ln(w2)) AS z1,
  ((1e0-2e0/(9e0*a)) - cbrt((1e0-2e0/a)/(1e0+x*sqrt(2e0/(a-4)))))/sqrt(2e0/(9e0*a)) AS z2 FROM k3)"""
)
register(
    "e5_normality_statistic",
    lambda spark, d: _normality(listings(spark, d)),
    _K2_SQL,
    "SELECT z1*z1 + z2*z2 AS k2, exp(-(z1*z1 + z2*z2)/2e0) AS normality_p FROM k4",
    k2=4,
    normality_p=12,
)


def _normality(rows: DataFrame) -> DataFrame:
    from gablework.functions.stats import normality_k2

    moments = E.residual_moments(rows)
    k2 = normality_k2(F.col("n"), F.col("skewness"), F.col("kurtosis"))
    return moments.select(k2.alias("k2"), "normality_p")


register(
    "e6_sample_statistics",
    lambda spark, d: E.sample_statistics(listings(spark, d)),
    LISTINGS_SQL,
    """SELECT count(*) AS n, stddev_samp(price-predicted)*1.96e0 AS half_width_95, avg(price) AS target_mean,
  stddev_samp(price) AS target_std, avg(predicted) AS prediction_mean, stddev_pop(predicted) AS prediction_std FROM listings""",
    half_width_95=3,
    target_mean=3,
    target_std=3,
    prediction_mean=3,
    prediction_std=3,
)
_SEGMENT_COLS = """count(*) AS n,
 CASE WHEN count(*) >= 2 AND var_pop(price) <> 0 THEN 1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) END AS r2,
 sqrt(avg((price-predicted)*(price-predicted))) AS rmse"""
register(
    "e7_price_bands",
    lambda spark, d: E.by_price_band(listings(spark, d)),
    LISTINGS_SQL,
    f"""SELECT CASE WHEN price < 200000 THEN '0k-200k' WHEN price < 400000 THEN '200k-400k'
  WHEN price < 600000 THEN '400k-600k' ELSE '600k+' END AS band, {_SEGMENT_COLS} FROM listings GROUP BY 1""",
    r2=7,
    rmse=3,
)
register(
    "e8_quartile_segments",
    lambda spark, d: E.by_quartile(staged(spark, d)),
    LISTINGS_SQL
    + ", cut AS (SELECT quantile_cont(price,0.25) AS q1, quantile_cont(price,0.75) AS q3 FROM listings)",
    f"""SELECT CASE WHEN price <= q1 THEN 'low_price' WHEN price <= q3 THEN 'medium_price' ELSE 'high_price' END AS segment,
  {_SEGMENT_COLS} FROM listings, cut GROUP BY 1""",
    r2=7,
    rmse=3,
)
register(
    "e9_quintile_segments",
    lambda spark, d: E.by_quintile(staged(spark, d)),
    LISTINGS_SQL
    + """, cut AS (SELECT quantile_cont(price,0.2) AS a, quantile_cont(price,0.4) AS b, quantile_cont(price,0.6) AS c,
  quantile_cont(price,0.8) AS e FROM listings)""",
    f"""SELECT CASE WHEN price <= a THEN 'very low' WHEN price <= b THEN 'low' WHEN price <= c THEN 'medium'
  WHEN price <= e THEN 'high' ELSE 'very high' END AS segment, {_SEGMENT_COLS} FROM listings, cut GROUP BY 1""",
    r2=7,
    rmse=3,
)
_SCENARIO_CTE = (
    LISTINGS_SQL
    + """, cut AS (SELECT quantile_cont(area,0.25) AS q1, quantile_cont(area,0.75) AS q3 FROM listings),
listed AS (
  SELECT price, predicted, CAST(bedrooms AS VARCHAR) || '_bedrooms' AS scenario FROM listings
  UNION ALL SELECT price, predicted, 'area_small' FROM listings, cut WHERE area <= q1
  UNION ALL SELECT price, predicted, 'area_medium' FROM listings, cut WHERE area BETWEEN q1 AND q3
  UNION ALL SELECT price, predicted, 'area_large' FROM listings, cut WHERE area >= q3
  UNION ALL SELECT price, predicted, 'age_new' FROM listings WHERE age_years >= 0 AND age_years < 5
  UNION ALL SELECT price, predicted, 'age_modern' FROM listings WHERE age_years >= 5 AND age_years < 20
  UNION ALL SELECT price, predicted, 'age_old' FROM listings WHERE age_years >= 20 AND age_years < 100)"""
)
_SCENARIO_SQL = f"SELECT scenario, {_SEGMENT_COLS} FROM listed GROUP BY scenario HAVING count(*) >= 5"
register("e10_scenarios", lambda spark, d: E.by_scenario(staged(spark, d)), _SCENARIO_CTE, _SCENARIO_SQL, r2=7, rmse=3)
register(
    "e11_weak_scenarios",
    lambda spark, d: E.weak_scenarios(E.by_scenario(staged(spark, d)), 0.93),
    _SCENARIO_CTE,
    f"SELECT * FROM ({_SCENARIO_SQL}) WHERE r2 < 0.93e0",
    r2=7,
    rmse=3,
)
PRODUCTION_SQL = """avg(CASE WHEN predicted BETWEEN 50000 AND 2000000 THEN 1e0 ELSE 0e0 END)*100e0 AS coverage,
  stddev_samp(price-predicted)*1.96e0 AS half_width_95,
  avg(CASE WHEN abs((price-predicted)/price)*100e0 < 20 THEN 1e0 ELSE 0e0 END)*100e0 AS within_20_percent,
  stddev_pop(predicted)/avg(predicted) AS stability"""
register(
    "e12_e13_e15_production_metrics",
    lambda spark, d: E.production_metrics(listings(spark, d)),
    LISTINGS_SQL,
    f"SELECT {PRODUCTION_SQL} FROM listings",
    coverage=6,
    half_width_95=3,
    within_20_percent=6,
    stability=8,
)
register(
    "e14_error_quantiles",
    lambda spark, d: E.error_quantiles(listings(spark, d)),
    LISTINGS_SQL,
    """SELECT quantile_cont(e,0.25) AS p25, quantile_cont(e,0.5) AS p50, quantile_cont(e,0.75) AS p75, quantile_cont(e,0.95) AS p95
  FROM (SELECT abs((price-predicted)/price)*100e0 AS e FROM listings)""",
    p25=6,
    p50=6,
    p75=6,
    p95=6,
)
register(
    "e16_confidence_histogram",
    lambda spark, d: E.confidence_histogram(staged(spark, d)),
    LISTINGS_SQL + ", conf AS (SELECT 1e0 - abs(price-predicted)/price AS score FROM listings)",
    "SELECT *, (SELECT avg(score) FROM conf) AS mean_score FROM (" + _histogram_sql("score", "conf") + ")",
    lower=6,
    upper=6,
    mean_score=8,
)
register(
    "e17_residual_outliers",
    lambda spark, d: E.residual_outliers(staged(spark, d)),
    LISTINGS_SQL + ", lim AS (SELECT stddev_samp(price-predicted)*2e0 AS t FROM listings)",
    """SELECT max(t) AS threshold, count(*) FILTER (WHERE abs(price-predicted) > t) AS outliers,
  avg(CASE WHEN abs(price-predicted) > t THEN 1e0 ELSE 0e0 END)*100e0 AS percent FROM listings, lim""",
    threshold=3,
    percent=6,
)
register(
    "e18_worst_predictions",
    lambda spark, d: E.worst_predictions(listings(spark, d), "listing_id"),
    LISTINGS_SQL,
    """SELECT listing_id, price, predicted, price-predicted AS residual, abs(price-predicted) AS absolute_residual
  FROM listings ORDER BY abs(price-predicted) DESC, listing_id LIMIT 5""",
    price=4,
    predicted=4,
    residual=4,
    absolute_residual=4,
)
BUSINESS_SQL = """count(*) FILTER (WHERE predicted BETWEEN 50000 AND 2000000) AS valid_predictions, count(*) AS total_predictions,
  avg(CASE WHEN predicted BETWEEN 50000 AND 2000000 THEN 1e0 ELSE 0e0 END) AS pass_rate,
  count(*) FILTER (WHERE abs(predicted-price)/price > 1e0) AS errors_over_100_percent,
  avg(CASE WHEN abs(predicted-price)/price > 1e0 THEN 1e0 ELSE 0e0 END) AS extreme_error_rate,
  stddev_pop(predicted)/avg(predicted) AS variation"""
register(
    "e19_business_rules",
    lambda spark, d: E.business_rules(listings(spark, d)),
    LISTINGS_SQL,
    f"SELECT *, variation < 1e0 AS consistent FROM (SELECT {BUSINESS_SQL} FROM listings)",
    pass_rate=8,
    extreme_error_rate=8,
    variation=8,
)

# --- gates -----------------------------------------------------------------

_LIMITS = {**QUALITY_GATES, "max_mae": 50_000.0}
register(
    "e20_threshold_gate",
    lambda spark, d: G.check_thresholds(E.evaluate(listings(spark, d)), _LIMITS),
    LISTINGS_SQL + f", m AS (SELECT {CORE_SQL} FROM listings)",
    """SELECT 'min_r2' AS threshold, r2 AS value, 0.7e0 AS "limit", r2 >= 0.7e0 AS passed FROM m
  UNION ALL SELECT 'max_rmse', rmse, 100000e0, rmse <= 100000e0 FROM m
  UNION ALL SELECT 'max_mape', mape, 15e0, mape <= 15e0 FROM m
  UNION ALL SELECT 'max_mae', mae, 50000e0, mae <= 50000e0 FROM m""",
    value=3,
)
register(
    "e20_threshold_verdict",
    lambda spark, d: G.meets_thresholds(E.evaluate(listings(spark, d), ["district"]).where("district = 'ASIA'"), _LIMITS),
    LISTINGS_SQL + f", m AS (SELECT {CORE_SQL} FROM listings WHERE district = 'ASIA')",
    "SELECT r2 >= 0.7e0 AND rmse <= 100000e0 AND mape <= 15e0 AND mae <= 50000e0 AS passed FROM m",
)


def _noise(rows: DataFrame) -> DataFrame:
    def score(noisy: DataFrame) -> DataFrame:
        return noisy.withColumn("prediction", P.rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=50_000))

    return B.noise_effect(rows, score, row_id="listing_id")


_NOISE_COLS = ("area", "bedrooms", "bathrooms", "age_years", "has_garage")
_U = "(CAST(CAST('0x' || substr(h{b},{at},8) AS BIGINT) AS DOUBLE) + 1e0)/4294967297e0"


def _normal_sql(i: int) -> str:
    block, inside = divmod(i, 4)
    pair, fn = (1 if inside < 2 else 17), ("cos" if inside % 2 == 0 else "sin")
    u1, u2 = _U.format(b=block, at=pair), _U.format(b=block, at=pair + 8)
    return f"sqrt(ln({u1})*-2e0)*{fn}({u2}*6.283185307179586e0)"


NOISE_SQL = (
    LISTINGS_SQL
    + ", spread AS (SELECT "
    + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in _NOISE_COLS)
    + """ FROM listings),
levels AS (SELECT unnest([0e0, 0.01e0, 0.05e0, 0.1e0]) AS noise_level),
hashed AS (SELECT *, md5(concat_ws('|', listing_id, CAST(CAST(round(noise_level*1000) AS INT) AS VARCHAR), '0')) AS h0,
  md5(concat_ws('|', listing_id, CAST(CAST(round(noise_level*1000) AS INT) AS VARCHAR), '1')) AS h1 FROM listings, levels),
noisy AS (SELECT noise_level, price, multiplier, """
    + ", ".join(f"{c} + {_normal_sql(i)}*noise_level*s_{c} AS {c}" for i, c in enumerate(_NOISE_COLS))
    + """ FROM hashed, spread),
scored AS (SELECT noise_level, price, greatest((2000e0*area + 50000e0*bedrooms + 30000e0*bathrooms - 5000e0*age_years
  + 25000e0*has_garage)*multiplier, 50000e0) AS p FROM noisy),
by_level AS (SELECT noise_level, 1e0 - sum((price-p)*(price-p))/(count(*)*var_pop(price)) AS r2 FROM scored GROUP BY noise_level),
effect AS (SELECT noise_level, r2, (b - r2)/b*100e0 AS drop_percent FROM by_level,
  (SELECT r2 AS b FROM by_level WHERE noise_level = 0) WHERE noise_level > 0),
robust AS (SELECT max(drop_percent) AS max_drop, greatest(0e0, 1e0 - max(drop_percent)/20e0) AS robustness_score FROM effect)"""
)
register(
    "e27_noise_effect",
    lambda spark, d: _noise(staged(spark, d)),
    NOISE_SQL,
    "SELECT noise_level, r2, drop_percent FROM effect",
    noise_level=3,
    r2=8,
    drop_percent=6,
)
register(
    "e27_robustness_score",
    lambda spark, d: B.robustness_score(_noise(staged(spark, d))).withColumn("label", G.noise_label()),
    NOISE_SQL,
    """SELECT max_drop, robustness_score, CASE WHEN max_drop < 5 THEN 'very robust' WHEN max_drop < 10 THEN 'robust'
  WHEN max_drop < 20 THEN 'moderately robust' ELSE 'fragile' END AS label FROM robust""",
    max_drop=6,
    robustness_score=8,
)


def _random_noise(spark, d):
    def score(noisy: DataFrame) -> DataFrame:
        return noisy.withColumn("prediction", P.rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=50_000))

    return B.noise_effect(staged(spark, d), score)


register("e27_random_noise_effect", _random_noise)


def _judgement(spark, d) -> DataFrame:
    """Metrics, business rules and robustness in one row."""
    rows = staged(spark, d)
    wide = rows.agg(
        *named(core_metrics(), "r2", "rmse", "mape"),
        F.avg(F.when(E.in_range(), 1.0).otherwise(0.0)).alias("pass_rate"),
        F.avg(F.when(E.confidence_score() < 0.0, 1.0).otherwise(0.0)).alias("extreme_error_rate"),
    )
    robust = B.robustness_score(_noise(rows))
    return wide.withColumn("robustness_score", robust.select("robustness_score").scalar())


_JUDGE_CTE = (
    NOISE_SQL
    + f""", judged AS (SELECT r2, rmse, mape, pass_rate, extreme_error_rate,
  (SELECT robustness_score FROM robust) AS robustness_score
  FROM (SELECT {CORE_SQL} FROM listings), (SELECT {BUSINESS_SQL} FROM listings)),
scores AS (SELECT *, r2*0.4e0 + (1e0-least(rmse/100000e0,1e0))*0.3e0 + (1e0-least(mape/15e0,1e0))*0.3e0 AS validation_score,
  pass_rate*0.5e0 + (1e0-extreme_error_rate)*0.5e0 AS business_score FROM judged),
overall AS (SELECT *, validation_score*0.5e0 + robustness_score*0.3e0 + business_score*0.2e0 AS overall_score FROM scores)"""
)
_JUDGE_DIGITS = dict(validation_score=8, business_score=8, overall_score=8)
register(
    "e21_e22_scores_and_grade",
    lambda spark, d: G.approve(_judgement(spark, d), 0.7, 100_000.0, 15.0).select(
        "validation_score", "business_score", "overall_score", "grade"
    ),
    _JUDGE_CTE,
    """SELECT validation_score, business_score, overall_score, CASE WHEN overall_score >= 0.9e0 THEN 'A+'
  WHEN overall_score >= 0.8e0 THEN 'A' WHEN overall_score >= 0.7e0 THEN 'B+' WHEN overall_score >= 0.6e0 THEN 'B'
  WHEN overall_score >= 0.5e0 THEN 'C' ELSE 'F' END AS grade FROM overall""",
    **_JUDGE_DIGITS,
)
register(
    "e23_approval",
    lambda spark, d: G.approve(_judgement(spark, d), 0.95, 50_000.0, 10.0).select(
        "approved", "business_criteria_met", "reasons"
    ),
    _JUDGE_CTE,
    """SELECT r2 >= 0.95e0 AND rmse <= 50000e0 AND mape <= 10e0 AND robustness_score >= 0.7e0 AS approved,
  business_score >= 0.8e0 AS business_criteria_met,
  concat_ws('; ', CASE WHEN r2 < 0.95e0 THEN printf('R2 %.4f below minimum 0.95', r2) END,
   CASE WHEN rmse > 50000e0 THEN printf('RMSE %,.0f above maximum 50,000', rmse) END,
   CASE WHEN mape > 10e0 THEN printf('MAPE %.1f%% above maximum 10.0%%', mape) END,
   CASE WHEN robustness_score < 0.7e0 THEN printf('robustness score %.3f below threshold 0.7', robustness_score) END) AS reasons
  FROM overall""",
)


def _ready(spark, d) -> DataFrame:
    rows = listings(spark, d)
    wide = rows.agg(
        F.avg(F.when(E.in_range(), 1.0).otherwise(0.0)).alias("c"),
        F.avg(F.when(E.percent_error("price", "predicted") < 20, 1.0).otherwise(0.0)).alias("w"),
        r2("price", "predicted").alias("r2"),
        rmse("price", "predicted").alias("rmse"),
        ratio(F.stddev_pop("predicted"), F.avg("predicted")).alias("stability"),
    )
    return G.readiness(
        wide.select(
            (F.col("c") * 100.0).alias("coverage"), (F.col("w") * 100.0).alias("within_20_percent"), "r2", "rmse", "stability"
        )
    )


_READY_CTE = (
    LISTINGS_SQL
    + f""", base AS (SELECT coverage, within_20_percent, r2, rmse, stability FROM
  (SELECT {PRODUCTION_SQL} FROM listings), (SELECT {CORE_SQL} FROM listings)),
ready AS (SELECT *, coverage >= 95 AS coverage_ok, within_20_percent >= 70 AS accuracy_ok, r2 >= 0.7e0 AS r2_ok,
  stability < 1e0 AS stability_ok FROM base),
readied AS (SELECT *, CAST(coverage_ok AS INT) + CAST(accuracy_ok AS INT) + CAST(r2_ok AS INT) + CAST(stability_ok AS INT)
  AS criteria_passed FROM ready),
final AS (SELECT *, criteria_passed*100e0/4 AS readiness_percent, criteria_passed*100e0/4 >= 75 AS ready FROM readied)"""
)
register(
    "e24_readiness",
    _ready,
    _READY_CTE,
    "SELECT * FROM final",
    coverage=6,
    within_20_percent=6,
    r2=8,
    rmse=3,
    stability=8,
    readiness_percent=2,
)


def _certificate(spark, d):
    drop = B.robustness_score(_noise(staged(spark, d))).select("max_drop").scalar()
    return G.certificate(_ready(spark, d).withColumn("max_drop", drop), "2025-08-31")


register(
    "e25_certificate",
    _certificate,
    NOISE_SQL + _READY_CTE[len(LISTINGS_SQL) :],
    """SELECT 'model_20250831' AS model_id, '2025-08-31' AS certified_on,
  strftime(DATE '2025-08-31' + INTERVAL 6 MONTH, '%Y-%m-%d') AS expires_on, 'APPROVED' AS status,
  readiness_percent AS quality_score,
  concat_ws('; ', printf('R2 %.4f >= 0.70', r2), printf('coverage %.1f%% >= 95%%', coverage),
   printf('accuracy %.1f%% >= 70%%', within_20_percent), printf('noise drop %.1f%% <= 20%%', max_drop)) AS criteria
  FROM final, robust WHERE ready""",
    quality_score=2,
)


def _monitoring(spark, d):
    rows = staged(spark, d)
    weak = E.weak_scenarios(E.by_scenario(rows), 0.93)
    # Weak scenarios are named once each; there are as many as scenario labels.
    names = weak.agg(F.array_join(F.array_sort(F.collect_list("scenario")), ", ").alias("names"))
    drop = B.robustness_score(_noise(rows)).select("max_drop").scalar()
    base = rows.agg(
        r2("price", "predicted").alias("r2"),
        (F.avg(F.when(E.percent_error("price", "predicted") < 20, 1.0).otherwise(0.0)) * 100.0).alias("within_20_percent"),
    )
    return G.monitoring_report(
        base.withColumn("max_drop", drop).withColumn("weak_scenarios", names.select("names").scalar())
    )


register(
    "e26_e30_monitoring_report",
    _monitoring,
    NOISE_SQL
    + _SCENARIO_CTE[len(LISTINGS_SQL) :]
    + f""", weak AS (SELECT coalesce(string_agg(scenario, ', ' ORDER BY scenario), '') AS names FROM ({_SCENARIO_SQL}) WHERE r2 < 0.93e0),
base AS (SELECT r2, within_20_percent, (SELECT max_drop FROM robust) AS max_drop, (SELECT names FROM weak) AS weak_scenarios
  FROM (SELECT {PRODUCTION_SQL} FROM listings), (SELECT {CORE_SQL} FROM listings))""",
    """SELECT *, r2 < 0.8e0 AS needs_features, max_drop > 15 AS needs_input_checks, within_20_percent < 80 AS needs_alerts,
  CASE WHEN max_drop < 10 THEN 'Good' WHEN max_drop < 20 THEN 'Moderate' ELSE 'Poor' END AS noise_tolerance,
  coalesce(nullif(concat_ws('; ', CASE WHEN r2 < 0.8e0 THEN 'collect more features to raise accuracy' END,
   CASE WHEN max_drop > 15 THEN 'validate inputs strictly in production' END,
   CASE WHEN within_20_percent < 80 THEN 'alert on predictions of high uncertainty' END,
   CASE WHEN weak_scenarios <> '' THEN 'watch these scenarios: ' || weak_scenarios END), ''),
   'model is sound; keep standard monitoring') AS recommendations FROM base""",
    r2=8,
    within_20_percent=6,
    max_drop=6,
)


def _edges(spark, d, rows=EDGE_ROWS_WIDE):
    """Edge rows in every district of the data, judged against the observed prices.

    The districts and the band come from the listings; the rule price scores.
    """
    data = staged(spark, d)
    cases = F.array(
        *[
            F.struct(
                F.lit(name).alias("case_name"),
                F.lit(float(area)).alias("area"),
                F.lit(bedrooms).alias("bedrooms"),
                F.lit(bathrooms).alias("bathrooms"),
                F.lit(float(age)).alias("age_years"),
                F.lit(garage).alias("has_garage"),
            )
            for name, area, bedrooms, bathrooms, age, garage in rows
        ]
    )
    # As many rows as districts, each with the few cases.
    edges = data.select("district").distinct().select("district", F.inline(cases))
    half = data.agg((F.stddev_samp(F.col("price") - F.col("predicted")) * 1.96).alias("h")).select("h").scalar()
    scored = edges.withColumn("prediction", P.rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=50_000))
    return scored.select(
        "case_name",
        "district",
        "prediction",
        (F.col("prediction") - half).alias("lower_bound"),
        E.in_range("prediction").alias("reasonable"),
    )


def _edge_sql(rows) -> str:
    values = ", ".join(f"('{n}', {a}e0, {b}, {c}, {y}e0, {g})" for n, a, b, c, y, g in rows)
    return f"""edge(case_name, area, bedrooms, bathrooms, age_years, has_garage) AS (VALUES {values}),
places AS (SELECT DISTINCT district, multiplier FROM listings),
edged AS (SELECT case_name, district, greatest((2000e0*area + 50000e0*bedrooms + 30000e0*bathrooms - 5000e0*age_years
  + 25000e0*has_garage)*multiplier, 50000e0) AS prediction FROM edge, places)"""


register(
    "e28_edge_cases",
    _edges,
    LISTINGS_SQL + ", " + _edge_sql(EDGE_ROWS_WIDE),
    """SELECT case_name, district, prediction, prediction - (SELECT stddev_samp(price-predicted)*1.96e0 FROM listings) AS lower_bound,
  prediction BETWEEN 50000 AND 2000000 AS reasonable FROM edged""",
    prediction=4,
    lower_bound=3,
)
register(
    "e28_edge_summary",
    lambda spark, d: B.edge_summary(_edges(spark, d, EDGE_ROWS)),
    LISTINGS_SQL + ", " + _edge_sql(EDGE_ROWS),
    """SELECT min(prediction) AS lowest, max(prediction) AS highest, max(prediction)/min(prediction) AS max_min_ratio,
  count(*) FILTER (WHERE prediction BETWEEN 50000 AND 2000000) AS reasonable_cases, count(*) AS cases FROM edged""",
    lowest=4,
    highest=4,
    max_min_ratio=6,
)
register(
    "e29_metric_table",
    lambda spark, d: G.metric_table(E.evaluate(L.split_three_ways(listings(spark, d), "listing_id"), ["split"])),
    SPLIT_SQL + f", m AS (SELECT split, {CORE_SQL} FROM parts GROUP BY split)",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, max({m}) FILTER (WHERE split = 'validation') AS validation,
  max({m}) FILTER (WHERE split = 'test') AS test FROM m"""
        for m in ("rmse", "mae", "r2", "mape")
    ),
    validation=3,
    test=3,
)

# --- intervals and model comparison over two rule models -------------------

register(
    "t13_residual_interval",
    lambda spark, d: E.residual_interval(staged(spark, d)).select("listing_id", "lower_bound", "upper_bound"),
    LISTINGS_SQL + ", h AS (SELECT stddev_samp(price-predicted)*1.96e0 AS half FROM listings)",
    "SELECT listing_id, predicted - half AS lower_bound, predicted + half AS upper_bound FROM listings, h",
    lower_bound=3,
    upper_bound=3,
)


def _two_models(spark, d) -> DataFrame:
    both = listings(spark, d).withColumn("other", P.rule_price(PRICE_WEIGHTS_V2, DISTRICT_FACTORS, absolute=True))
    one, two = core_metrics("price", "predicted"), core_metrics("price", "other")
    return both.agg(
        *[one[m].alias(f"{m}_1") for m in ("r2", "rmse", "mae")], *[two[m].alias(f"{m}_2") for m in ("r2", "rmse", "mae")]
    )


_TWO_SQL = (
    LISTINGS_SQL
    + f""", pair AS (SELECT price, predicted, abs((3000e0*area + 15000e0*bedrooms + 10000e0*bathrooms + 25000e0*has_garage
  - 1000e0*age_years)*multiplier) AS other FROM listings),
two AS (SELECT a.r2 AS r2_1, a.rmse AS rmse_1, a.mae AS mae_1, b.r2 AS r2_2, b.rmse AS rmse_2, b.mae AS mae_2 FROM
  (SELECT {CORE_SQL} FROM pair) a, (SELECT {CORE_SQL.replace('predicted', 'other')} FROM pair) b)"""
)
register(
    "t15_champion",
    lambda spark, d: G.champion(
        _two_models(spark, d).select(
            F.inline(
                F.array(
                    F.struct(F.lit("baseline").alias("model"), F.col("r2_1").alias("r2")),
                    F.struct(F.lit("tuned").alias("model"), F.col("r2_2").alias("r2")),
                )
            )
        )
    ),
    _TWO_SQL,
    """SELECT CASE WHEN r2_2 > r2_1 THEN 'tuned' ELSE 'baseline' END AS model, greatest(r2_1, r2_2) AS r2 FROM two""",
    r2=8,
)
register(
    "t16_improvement",
    lambda spark, d: G.improvement(
        _two_models(spark, d).select(
            *[F.col(f"{m}_2").alias(f"{m}_base") for m in ("r2", "rmse", "mae")],
            *[F.col(f"{m}_1").alias(f"{m}_tuned") for m in ("r2", "rmse", "mae")],
        )
    ),
    _TWO_SQL
    + """, imp AS (SELECT 'rmse' AS metric, (rmse_2-rmse_1)/rmse_2*100e0 AS percent FROM two
  UNION ALL SELECT 'mae', (mae_2-mae_1)/mae_2*100e0 FROM two UNION ALL SELECT 'r2', (r2_1-r2_2)/r2_2*100e0 FROM two)""",
    "SELECT metric, percent, CASE WHEN percent > 0 THEN 'better' ELSE 'worse' END AS direction FROM imp",
    percent=6,
)
register(
    "t17_model_comparison",
    lambda spark, d: G.compare_models(_two_models(spark, d).drop("mae_1", "mae_2")),
    _TWO_SQL,
    """SELECT r2_1, rmse_1, r2_2, rmse_2, CASE WHEN r2_1 > r2_2 THEN 'model1' ELSE 'model2' END AS better_model,
  CASE WHEN r2_1 > r2_2 THEN (r2_1-r2_2)/r2_2 ELSE (r2_2-r2_1)/r2_1 END*100e0 AS improvement_percent FROM two""",
    r2_1=8,
    rmse_1=3,
    r2_2=8,
    rmse_2=3,
    improvement_percent=6,
)


def _overfit(spark, d):
    by_split = E.evaluate(L.split_three_ways(listings(spark, d), "listing_id"), ["split"])
    wide = by_split.agg(
        F.max(F.when(F.col("split") == "validation", F.col("r2"))).alias("validation_r2"),
        F.max(F.when(F.col("split") == "test", F.col("r2"))).alias("test_r2"),
    )
    return wide.withColumn("overfit", G.overfit_flag(F.col("validation_r2"), F.col("test_r2")))


register(
    "t19_overfit_check",
    _overfit,
    SPLIT_SQL + f", m AS (SELECT split, {CORE_SQL} FROM parts GROUP BY split)",
    """SELECT v.r2 AS validation_r2, t.r2 AS test_r2, t.r2 < v.r2 - 0.05e0 AS overfit
  FROM m v, m t WHERE v.split = 'validation' AND t.split = 'test'""",
    validation_r2=8,
    test_r2=8,
)
