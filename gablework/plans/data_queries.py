"""Registered queries: sources, cleaning, features, splits, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gablework.functions.columns import num, scalar
from gablework.operators import features as P
from gablework.operators import quality as Q
from gablework.operators import splits as L
from gablework.plans.listings import (
    GAPPY_SQL,
    LISTINGS_SQL,
    SERVING_SQL,
    gappy_listings,
    listings,
    serving_log,
    table,
)
from gablework.plans.registry import register
from gablework.roles import (
    DISTRICT_FACTORS,
    FEATURES_11,
    PRICE_WEIGHTS_V1,
    PRICE_WEIGHTS_V2,
    RANGE_RULES,
    RECORD_RULES,
    SCHEMA_RULES,
    THREE_RULES,
)
from gablework.session import scratch_path, stage
from gablework.sources import logs, reports, tables, tail
from gablework.sources.manifest import Store
from gablework.streaming.telemetry import run_once

RAW = ["area", "bedrooms", "bathrooms", "age_years", "has_garage", "district", "price"]
NUMERIC = ["area", "bedrooms", "bathrooms", "age_years", "has_garage", "price"]


def staged(spark: SparkSession, d: str) -> DataFrame:
    return stage(listings(spark, d), "listings")


# --- sources and sinks -----------------------------------------------------


def _csv_scan(spark, d):
    path = scratch_path(spark, "csv")
    tables.write_csv(listings(spark, d).select(*RAW), path)
    return tables.read_csv(spark, path).groupBy("district").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean_price"), F.max("area").alias("max_area")
    )


_DISTRICT_MEANS = """SELECT district, count(*) AS n, avg(price) AS mean_price, max(area) AS max_area
  FROM listings GROUP BY district"""

register("s1_csv_scan", _csv_scan, LISTINGS_SQL, _DISTRICT_MEANS, mean_price=3, max_area=3)


def _labelled_scan(spark, d):
    path = scratch_path(spark, "labelled")
    tables.write_parquet(listings(spark, d), path)
    return tables.read_labelled(spark, path, ["listing_id", "area", "bedrooms"], "price").where("area > 250")


register(
    "s2_labelled_scan",
    _labelled_scan,
    LISTINGS_SQL,
    "SELECT listing_id, area, bedrooms, price FROM listings WHERE area > 250e0",
    area=6,
    price=6,
)


def _schema_document(spark, d):
    """Limits taken from the data are written as a schema document and read back as rules."""
    seen = listings(spark, d).agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in NUMERIC],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in NUMERIC],
    )
    rules = F.map_from_entries(
        F.array(
            *[
                F.struct(F.lit(c).alias("k"), F.struct(F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max")))
                for c in NUMERIC
            ]
        )
    )
    path = scratch_path(spark, "schema")
    document = seen.select(F.array(*[F.lit(c) for c in NUMERIC]).alias("feature_names"), rules.alias("validation_rules"))
    reports.write_report(document, path)
    return reports.read_rules(spark, path).select("feature", "low", "high")


register(
    "s3_schema_document",
    _schema_document,
    LISTINGS_SQL,
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM listings"
        for c in NUMERIC
    ),
    low=4,
    high=4,
)


def _report_projection(spark, d):
    from gablework.operators.evaluate import evaluate

    path = scratch_path(spark, "metrics")
    found = evaluate(listings(spark, d)).select(
        F.lit("rule").alias("model_type"),
        F.col("rmse").alias("final_rmse"),
        F.col("mae").alias("final_mae"),
        F.col("r2").alias("final_r2"),
        F.col("mape").alias("final_mape"),
        F.array(*[F.lit(c) for c in FEATURES_11]).alias("features"),
    )
    reports.write_report(found, path)
    return reports.read_model_info(spark, path).drop("training_date")


CORE_SQL = """count(*) AS n, avg((price-predicted)*(price-predicted)) AS mse,
 sqrt(avg((price-predicted)*(price-predicted))) AS rmse, avg(abs(price-predicted)) AS mae,
 CASE WHEN count(*) >= 2 AND var_pop(price) <> 0 THEN 1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) END AS r2,
 avg(abs((price-predicted)/price))*100e0 AS mape"""

register(
    "s4_report_projection",
    _report_projection,
    LISTINGS_SQL,
    f"SELECT 'rule' AS model_type, rmse, mae, r2, mape, CAST(11 AS INT) AS n_features FROM (SELECT {CORE_SQL} FROM listings)",
    rmse=3,
    mae=3,
    r2=8,
    mape=6,
)


def _json_lines(spark, d):
    path = scratch_path(spark, "log")
    log = serving_log(spark, d).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp"),
        F.when(F.col("is_error") == 1, "ERROR").otherwise("INFO").alias("level"),
        F.col("user_id").cast("string").alias("client"),
        "variant",
        "response_time",
        "is_error",
    )
    log.write.json(path)
    parsed = logs.read_json_lines(spark, path)
    return parsed.groupBy("level", F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("response_time").alias("slowest")
    )


register(
    "s6_json_lines_log",
    _json_lines,
    SERVING_SQL,
    """SELECT CASE WHEN is_error = 1 THEN 'ERROR' ELSE 'INFO' END AS level, strftime(ts, '%Y-%m-%d %H') AS hour,
  count(*) AS n, max(response_time) AS slowest FROM serving GROUP BY ALL""",
    slowest=6,
)


def _tailed_log(spark, d):
    """The log as lines of growing files, in two runs of one stream; no line comes twice."""
    folder, out, state = (scratch_path(spark, n) for n in ("tail", "tail-out", "tail-state"))
    log = serving_log(spark, d).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp"),
        F.when(F.col("is_error") == 1, "ERROR").otherwise("INFO").alias("level"),
        F.col("user_id").cast("string").alias("client"),
        "variant",
        "response_time",
        "is_error",
    )
    for arm in ("canary", "stable"):
        log.where(F.col("variant") == arm).write.mode("append").json(folder)
        run_once(tail.tail_json_lines(spark, folder, pattern="*.json"), out, state)
    return spark.read.parquet(out).groupBy("level", "variant", F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("response_time").alias("slowest")
    )


register(
    "s6_tailed_log_stream",
    _tailed_log,
    SERVING_SQL,
    """SELECT CASE WHEN is_error = 1 THEN 'ERROR' ELSE 'INFO' END AS level, variant, strftime(ts, '%Y-%m-%d %H') AS hour,
  count(*) AS n, max(response_time) AS slowest FROM serving GROUP BY ALL""",
    slowest=6,
)


def _csv_sink(spark, d):
    path = scratch_path(spark, "csv-sink")
    tables.write_csv(Q.clean_by_rules(listings(spark, d), RANGE_RULES).select("listing_id", "bedrooms", "district"), path)
    return spark.read.option("header", True).schema("listing_id string, bedrooms int, district string").csv(path)


RANGE_WHERE = (
    "area > 30 AND area < 500 AND price > 50000 AND price < 2000000 AND age_years < 50 AND bedrooms >= 1 AND bathrooms >= 1"
)
register(
    "s7_csv_sink",
    _csv_sink,
    LISTINGS_SQL,
    f"SELECT listing_id, bedrooms, district FROM listings WHERE {RANGE_WHERE}",
)


def _split_sink(spark, d):
    path = scratch_path(spark, "splits")
    tables.write_splits(L.split_three_ways(listings(spark, d), "listing_id"), path)
    return tables.read_split(spark, path, "validation").select("listing_id", "price")


TEST_SQL = "substr(md5(concat_ws('|', listing_id, '42')),1,8) < '33333333'"
VALIDATION_SQL = "substr(md5(concat_ws('|', listing_id, '43')),1,8) < '33333333'"
SPLIT_SQL = f"""{LISTINGS_SQL},
parts AS (SELECT *, CASE WHEN {TEST_SQL} THEN 'test' WHEN {VALIDATION_SQL} THEN 'validation' ELSE 'train' END AS split
          FROM listings)"""
register(
    "s8_split_sink",
    _split_sink,
    SPLIT_SQL,
    "SELECT listing_id, price FROM parts WHERE split = 'validation'",
    price=6,
)


def _report_sink(spark, d):
    path = scratch_path(spark, "report")
    rows = listings(spark, d)
    report = rows.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.avg("price").alias("mean"),
        F.stddev_samp("price").alias("std"),
        F.min("price").alias("min"),
        F.max("price").alias("max"),
    )
    reports.write_report(reports.nest(report, target_statistics=["mean", "std", "min", "max"]), path)
    ddl = "total_samples bigint, target_statistics struct<mean: double, std: double, min: double, max: double>"
    return spark.read.schema(ddl).json(path).select("total_samples", "target_statistics.*")


register(
    "s9_report_sink",
    _report_sink,
    LISTINGS_SQL,
    "SELECT count(*) AS total_samples, avg(price) AS mean, stddev_samp(price) AS std, min(price) AS min, max(price) AS max FROM listings",
    mean=3,
    std=3,
    min=3,
    max=3,
)


def _audit_log(spark, d):
    path = scratch_path(spark, "audit")
    logs.append_audit(listings(spark, d).select("listing_id", "predicted"), path, "listing_id", 0.1)
    return spark.read.parquet(path)


register(
    "s10_audit_log",
    _audit_log,
    LISTINGS_SQL,
    "SELECT listing_id, predicted FROM listings WHERE substr(md5(listing_id),1,8) < '1999999a'",
    predicted=6,
)

register(
    "s11_retention_newest",
    lambda spark, d: tables.keep_newest(
        table(spark, d, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")),
        "at",
        "event_id",
    ),
    None,
    """SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
  ORDER BY 3 DESC, event_id LIMIT 10""",
)


def _versions(spark, d):
    """Orders committed by year; a failed writer, a replaced version and pruning leave what readers should see."""
    store = Store(spark, scratch_path(spark, "versions"))
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    for i, year in enumerate((1995, 1996, 1997)):
        store.append(orders.where(F.col("year") == year), now=float(i))
    store.write_set(orders)  # never committed
    store.replace(orders.where("year >= 1998"), now=3.0)
    store.append(orders.where("year = 1995"), now=4.0)
    store.prune(versions=2, grace_days=0.0)
    # The year 1996 is in pruned versions only.
    newest, before = store.read(), store.read(4)
    return newest.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")).withColumn(
        "before", before.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    )


register(
    "s11_versions",
    _versions,
    None,
    """SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, sum(o_totalprice) AS total,
  (SELECT count(*) FROM orders WHERE year(o_orderdate) >= 1998) AS before
  FROM orders WHERE year(o_orderdate) >= 1998 OR year(o_orderdate) = 1995 GROUP BY 1""",
    total=2,
)


def _retention_days(spark, d):
    orders = table(spark, d, "orders")
    newest = scalar(orders.agg(F.max("o_orderdate").cast("date").alias("day")), "day")
    return tables.keep_recent(orders, "o_orderdate", newest, 30).select("o_orderkey", "o_totalprice")


register(
    "s11_retention_days",
    _retention_days,
    None,
    """SELECT o_orderkey, o_totalprice FROM orders
  WHERE o_orderdate >= (SELECT CAST(max(o_orderdate) AS DATE) - INTERVAL 30 DAY FROM orders)""",
    o_totalprice=6,
)

# --- cleaning and quality --------------------------------------------------

register(
    "q1_fixed_range_clean",
    lambda spark, d: Q.clean_by_rules(listings(spark, d), RANGE_RULES).select("listing_id", "area", "price"),
    LISTINGS_SQL,
    f"SELECT listing_id, area, price FROM listings WHERE {RANGE_WHERE}",
    area=6,
    price=6,
)
register(
    "q2_three_rule_clean",
    lambda spark, d: Q.clean_by_rules(listings(spark, d), THREE_RULES).select("listing_id", "area", "price"),
    LISTINGS_SQL,
    "SELECT listing_id, area, price FROM listings WHERE area > 30 AND price > 50000 AND age_years < 50",
    area=6,
    price=6,
)

IQR_SQL = (
    LISTINGS_SQL
    + """,
fence_area AS (SELECT quantile_cont(area, 0.25) AS q1, quantile_cont(area, 0.75) AS q3 FROM listings),
kept_area AS (SELECT l.* FROM listings l, fence_area
  WHERE area >= q1 - 1.5e0*(q3-q1) AND area <= q3 + 1.5e0*(q3-q1)),
fence_price AS (SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3 FROM kept_area),
kept AS (SELECT k.* FROM kept_area k, fence_price
  WHERE price >= p1 - 1.5e0*(p3-p1) AND price <= p3 + 1.5e0*(p3-p1))"""
)
register(
    "q3_sequential_iqr_clean",
    lambda spark, d: Q.clean_by_iqr(staged(spark, d)).select("listing_id", "area", "price"),
    IQR_SQL,
    "SELECT listing_id, area, price FROM kept",
    area=6,
    price=6,
)


def _outlier_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", max(q1 - 1.5e0*(q3-q1)) AS lower, max(q3 + 1.5e0*(q3-q1)) AS upper,
  count(*) FILTER (WHERE {column} < q1 - 1.5e0*(q3-q1) OR {column} > q3 + 1.5e0*(q3-q1)) AS outliers,
  avg(CASE WHEN {column} < q1 - 1.5e0*(q3-q1) OR {column} > q3 + 1.5e0*(q3-q1) THEN 100e0 ELSE 0e0 END) AS percent,
  coalesce(array_to_string(list_transform(list_sort(list(DISTINCT {column}) FILTER (WHERE {column} < q1 - 1.5e0*(q3-q1)
     OR {column} > q3 + 1.5e0*(q3-q1)))[1:5], lambda v: printf('%.2f', v)), ', '), '') AS sample_values
  FROM listings, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM listings)"""


register(
    "q4_outlier_report",
    lambda spark, d: Q.outlier_report(listings(spark, d), ["area", "price", "age_years"]),
    LISTINGS_SQL,
    " UNION ALL ".join(_outlier_sql(c) for c in ("area", "price", "age_years")),
    lower=4,
    upper=4,
    percent=8,
)
register(
    "q5_removal_report",
    lambda spark, d: Q.removal_report(listings(spark, d), Q.all_hold(RANGE_RULES)),
    LISTINGS_SQL,
    f"""SELECT initial_rows, final_rows, initial_rows - final_rows AS removed_rows,
  (initial_rows - final_rows)*100e0/initial_rows AS removed_percent
  FROM (SELECT count(*) AS initial_rows, count(*) FILTER (WHERE {RANGE_WHERE}) AS final_rows FROM listings)""",
    removed_percent=8,
)

RECORD_BAD = [
    ("area", "NOT coalesce(area > 0, false)"),
    ("bedrooms", "NOT coalesce(bedrooms BETWEEN 1 AND 10, false)"),
    ("bathrooms", "NOT coalesce(bathrooms BETWEEN 1 AND 6, false)"),
    ("age_years", "NOT coalesce(age_years BETWEEN 0 AND 100, false)"),
    ("has_garage", "NOT coalesce(has_garage BETWEEN 0 AND 1, false)"),
]
register(
    "q6_record_validation",
    lambda spark, d: Q.check_records(gappy_listings(spark, d), RECORD_RULES).select(
        "listing_id", "is_valid", F.array_join("reasons", ",").alias("reasons")
    ),
    GAPPY_SQL,
    "SELECT listing_id, "
    + "NOT (" + " OR ".join(bad for _, bad in RECORD_BAD) + ") AS is_valid, concat_ws(',', "
    + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in RECORD_BAD)
    + ") AS reasons FROM gappy",
)
_SCORES = [("area", 30, 500), ("bedrooms", 1, 10), ("bathrooms", 1, 6), ("age_years", 0, 50), ("price", 50000, 2000000)]
_SCORE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} BETWEEN {lo} AND {hi}) AS valid_rows, count(*) AS total_rows,
  count(*) FILTER (WHERE {c} BETWEEN {lo} AND {hi})*1e0/count(*) AS score FROM gappy"""
    for c, lo, hi in _SCORES
)
register(
    "q7_rule_scores",
    lambda spark, d: Q.rule_scores(gappy_listings(spark, d), SCHEMA_RULES),
    GAPPY_SQL,
    _SCORE_SQL,
    score=8,
)
register(
    "q7_value_list_scores",
    lambda spark, d: Q.rule_scores(gappy_listings(spark, d), SCHEMA_RULES, use_allowed=True),
    GAPPY_SQL,
    _SCORE_SQL
    + """ UNION ALL SELECT 'has_garage', count(*) FILTER (WHERE has_garage IN (0,1)), count(*),
  count(*) FILTER (WHERE has_garage IN (0,1))*1e0/count(*) FROM gappy""",
    score=8,
)
register(
    "q8_schema_conformance",
    lambda spark, d: Q.conformance(gappy_listings(spark, d), SCHEMA_RULES, RAW),
    GAPPY_SQL,
    f"""SELECT avg(score) AS overall_score, true AS schema_compliance, avg(score) >= 0.95e0 AS is_valid
  FROM ({_SCORE_SQL})""",
    overall_score=8,
)
register(
    "q9_column_order",
    lambda spark, d: Q.schema_report(listings(spark, d), RAW + ["balcony"]).join(
        Q.null_profile(listings(spark, d), RAW), "column", "left"
    ),
    LISTINGS_SQL,
    """SELECT c AS "column", c <> 'balcony' AS present, false AS in_place,
  CASE WHEN c <> 'balcony' THEN CAST(0 AS BIGINT) END AS nulls
  FROM (SELECT unnest(['area','bedrooms','bathrooms','age_years','has_garage','district','price','balcony']) AS c)
  WHERE (SELECT count(*) FROM listings) > 0""",
)

_CELLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in RAW)
QUALITY_SQL = f"""SELECT completeness, validity, 1e0 AS consistency, 1e0 AS accuracy,
  completeness*0.3e0 + validity*0.4e0 + 0.15e0 + 0.15e0 AS quality_score FROM (
  SELECT 1e0 - sum(CASE WHEN {RANGE_WHERE} THEN {_CELLS} ELSE 0 END)*1e0/(count(*) FILTER (WHERE {RANGE_WHERE})*7) AS completeness,
         count(*) FILTER (WHERE {RANGE_WHERE})*1e0/count(*) AS validity FROM gappy)"""
register(
    "q10_quality_score",
    lambda spark, d: Q.quality_score(gappy_listings(spark, d), RANGE_RULES, RAW),
    GAPPY_SQL,
    QUALITY_SQL,
    completeness=8,
    validity=8,
    quality_score=8,
)
register(
    "q11_quality_gate",
    lambda spark, d: Q.quality_score(gappy_listings(spark, d), RANGE_RULES, RAW).select(
        "quality_score", (F.col("quality_score") >= 0.95).alias("passed")
    ),
    GAPPY_SQL,
    f"SELECT quality_score, quality_score >= 0.95e0 AS passed FROM ({QUALITY_SQL})",
    quality_score=8,
)
register(
    "q12_null_profile",
    lambda spark, d: Q.null_profile(gappy_listings(spark, d), RAW),
    GAPPY_SQL,
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM gappy" for c in RAW)
    + f" UNION ALL SELECT '(all)', CAST(sum({_CELLS}) AS BIGINT) FROM gappy",
)
register(
    "q13_median_imputation",
    lambda spark, d: Q.impute_median(
        stage(gappy_listings(spark, d)), ["area", "bedrooms", "bathrooms", "age_years", "has_garage"]
    ).select("listing_id", "area", "bedrooms", "age_years"),
    GAPPY_SQL,
    """SELECT listing_id, coalesce(area, (SELECT quantile_cont(area, 0.5) FROM gappy)) AS area,
  CAST(bedrooms AS DOUBLE) AS bedrooms,
  coalesce(age_years, (SELECT quantile_cont(age_years, 0.5) FROM gappy)) AS age_years FROM gappy""",
    area=6,
    age_years=6,
)
register(
    "q14_mean_imputation",
    lambda spark, d: Q.impute_mean(stage(gappy_listings(spark, d)), ["area", "age_years"]).select(
        "listing_id", "area", "age_years"
    ),
    GAPPY_SQL,
    """SELECT listing_id, coalesce(area, (SELECT avg(area) FROM gappy)) AS area,
  coalesce(age_years, (SELECT avg(age_years) FROM gappy)) AS age_years FROM gappy""",
    area=6,
    age_years=6,
)
register(
    "q15_size_requirement",
    lambda spark, d: Q.size_requirement(listings(spark, d), 11),
    LISTINGS_SQL,
    """SELECT count(*) AS rows, CAST(11 AS INT) AS features, count(*) BETWEEN 100 AND 100000 AS rows_ok,
  true AS features_ok FROM listings""",
)
register(
    "q16_mask_share",
    lambda spark, d: Q.mask_share(
        listings(spark, d),
        ((F.col("area") > 200) & (F.col("has_garage") == 1)) | (F.col("price") < 100_000),
    ),
    LISTINGS_SQL,
    """SELECT count(*) FILTER (WHERE m) AS rows, avg(CASE WHEN m THEN 1e0 ELSE 0e0 END) AS fraction
  FROM (SELECT (area > 200 AND has_garage = 1) OR price < 100000 AS m FROM listings)""",
    fraction=8,
)


def _known(spark, d) -> DataFrame:
    """Codes fitted without one district, so that it turns up as unknown."""
    return P.fit_labels(listings(spark, d).where("district <> 'EUROPE'"), "district")


register(
    "q17_unknown_labels",
    lambda spark, d: P.unknown_labels(listings(spark, d), _known(spark, d), "district"),
    LISTINGS_SQL,
    "SELECT district AS label, count(*) AS n FROM listings WHERE district = 'EUROPE' GROUP BY district",
)

# --- features --------------------------------------------------------------

CODES_SQL = (
    LISTINGS_SQL
    + """,
codes AS (SELECT district AS label, CAST(row_number() OVER (ORDER BY district) - 1 AS INT) AS code
          FROM (SELECT DISTINCT district FROM listings))"""
)
_DERIVED_SQL = """area/(bedrooms+1) AS area_per_room, bathrooms*1e0/bedrooms AS bathroom_ratio,
  age_years*age_years AS age_squared, bedrooms+bathrooms AS total_rooms, CAST(age_years < 5 AS INT) AS is_new"""
register(
    "p1_p5_derived_features",
    lambda spark, d: P.derive_features(listings(spark, d)).select(
        "listing_id", "area_per_room", "bathroom_ratio", "age_squared", "total_rooms", "is_new"
    ),
    LISTINGS_SQL,
    f"SELECT listing_id, {_DERIVED_SQL} FROM listings",
    area_per_room=6,
    bathroom_ratio=6,
    age_squared=6,
)


def _features_eleven(spark, d):
    rows = listings(spark, d)
    coded = P.apply_labels(rows, P.fit_labels(rows, "district"), "district", "district_code")
    return P.select_features(P.derive_features(coded), FEATURES_11, "listing_id")


register(
    "p6_feature_selection",
    _features_eleven,
    CODES_SQL,
    f"""SELECT listing_id, area, bedrooms, bathrooms, age_years, has_garage, code AS district_code, {_DERIVED_SQL}
  FROM listings JOIN codes ON district = label""",
    area=6,
    age_years=6,
    area_per_room=6,
    bathroom_ratio=6,
    age_squared=6,
)
register("p7_label_codes", lambda spark, d: P.fit_labels(listings(spark, d), "district"), CODES_SQL, "SELECT label, code FROM codes")
register(
    "p7_label_codes_many",
    lambda spark, d: P.fit_labels(table(spark, d, "customer"), "c_name"),
    None,
    """SELECT c_name AS label, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INT) AS code
  FROM (SELECT DISTINCT c_name FROM customer)""",
)
register(
    "p8_label_apply_strict",
    lambda spark, d: P.apply_labels(
        listings(spark, d), P.fit_labels(listings(spark, d), "district"), "district", "district_code", unknown="error"
    ).groupBy("district_code").agg(F.count(F.lit(1)).alias("n")),
    CODES_SQL,
    "SELECT code AS district_code, count(*) AS n FROM listings JOIN codes ON district = label GROUP BY code",
)
register(
    "p9_label_apply_default",
    lambda spark, d: P.apply_labels(listings(spark, d), _known(spark, d), "district", "district_code").select(
        "listing_id", "district", "district_code"
    ),
    LISTINGS_SQL,
    """SELECT listing_id, district, coalesce(code, 0) AS district_code FROM listings LEFT JOIN
  (SELECT district AS label, CAST(row_number() OVER (ORDER BY district) - 1 AS INT) AS code
   FROM (SELECT DISTINCT district FROM listings WHERE district <> 'EUROPE')) ON district = label""",
)
register(
    "p10_encode_strings",
    lambda spark, d: P.encode_strings(
        table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        ["o_orderstatus", "o_orderpriority"],
    ),
    None,
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INT) AS o_orderstatus,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INT) AS o_orderpriority FROM orders""",
)


def _scaled(spark, d):
    parts = stage(L.split_by_share(listings(spark, d), "listing_id"))
    columns = ["area", "bedrooms", "age_years"]
    scaler = P.fit_scaler(parts.where("split = 'train'"), columns)
    return P.apply_scaler(parts, scaler, columns).select("listing_id", "split", *columns)


register(
    "p11_standard_scale",
    _scaled,
    LISTINGS_SQL
    + f""",
two AS (SELECT *, CASE WHEN {TEST_SQL} THEN 'test' ELSE 'train' END AS split FROM listings),
fit AS (SELECT avg(area) AS ma, stddev_pop(area) AS sa, avg(bedrooms) AS mb, stddev_pop(bedrooms) AS sb,
               avg(age_years) AS my, stddev_pop(age_years) AS sy FROM two WHERE split = 'train')""",
    """SELECT listing_id, split, (area-ma)/sa AS area, (bedrooms-mb)/sb AS bedrooms, (age_years-my)/sy AS age_years
  FROM two, fit""",
    area=6,
    bedrooms=6,
    age_years=6,
)
register(
    "p12_drop_target",
    lambda spark, d: listings(spark, d).drop("price", "predicted", "listed_on", "age_years", "area"),
    LISTINGS_SQL,
    "SELECT listing_id, bedrooms, bathrooms, has_garage, district FROM listings",
)


def _assembled(spark, d):
    from pyspark.ml.functions import vector_to_array

    columns = ["area", "bedrooms", "bathrooms", "age_years", "has_garage"]
    rows = P.assemble(gappy_listings(spark, d), columns)
    return rows.select(
        "listing_id", F.aggregate(vector_to_array("features"), num(0), lambda acc, x: acc + x).alias("total")
    )


register(
    "p13_vector_assembly",
    _assembled,
    GAPPY_SQL,
    """SELECT listing_id, area + bedrooms + bathrooms + age_years + has_garage AS total FROM gappy
  WHERE area IS NOT NULL AND age_years IS NOT NULL""",
    total=6,
)
register(
    "p14_clip_predictions",
    lambda spark, d: listings(spark, d).select(
        "listing_id", P.clip(F.col("predicted") * 2.0 - 300_000.0, 50_000, 2_000_000).alias("clipped")
    ),
    LISTINGS_SQL,
    "SELECT listing_id, greatest(least(predicted*2e0 - 300000e0, 2000000e0), 50000e0) AS clipped FROM listings",
    clipped=6,
)
register(
    "p15_rule_price_v1",
    lambda spark, d: P.join_factors(listings(spark, d), DISTRICT_FACTORS).select(
        "listing_id", P.rule_price(PRICE_WEIGHTS_V1, factor=F.col("factor"), floor=50_000).alias("rule_price")
    ),
    LISTINGS_SQL,
    "SELECT listing_id, predicted AS rule_price FROM listings",
    rule_price=6,
)
register(
    "p16_rule_price_v2",
    lambda spark, d: listings(spark, d).select(
        "listing_id", P.rule_price(PRICE_WEIGHTS_V2, DISTRICT_FACTORS, absolute=True).alias("rule_price")
    ),
    LISTINGS_SQL,
    """SELECT listing_id, abs((3000e0*area + 15000e0*bedrooms + 10000e0*bathrooms + 25000e0*has_garage
  - 1000e0*age_years)*multiplier) AS rule_price FROM listings""",
    rule_price=5,
)
register(
    "p17_clip_inputs",
    lambda spark, d: gappy_listings(spark, d).select(
        "listing_id", P.clip("area", 50, 200).alias("area"), P.clip("age_years", 5, 10).alias("age_years")
    ),
    GAPPY_SQL,
    """SELECT listing_id, CASE WHEN area IS NOT NULL THEN greatest(least(area, 200e0), 50e0) END AS area,
  CASE WHEN age_years IS NOT NULL THEN greatest(least(age_years, 10e0), 5e0) END AS age_years FROM gappy""",
    area=6,
    age_years=6,
)


def preprocess(rows: DataFrame) -> DataFrame:
    """Clean by fences, fill, encode, split, scale by the training rows."""
    columns = ["area", "bedrooms", "bathrooms", "age_years", "has_garage", "district_code"]
    clean = Q.impute_median(Q.clean_by_iqr(rows), columns[:-1])
    coded = P.apply_labels(clean, P.fit_labels(clean, "district"), "district", "district_code")
    parts = stage(L.split_by_share(coded, "listing_id"), "preprocessed")
    scaler = P.fit_scaler(parts.where("split = 'train'"), columns)
    return P.apply_scaler(parts, scaler, columns).select("listing_id", "split", *columns, "price")


register(
    "p18_preprocessing_flow",
    lambda spark, d: preprocess(staged(spark, d)),
    IQR_SQL
    + f""",
coded AS (SELECT k.*, CAST(dense_rank() OVER (ORDER BY district) - 1 AS INT) AS district_code,
          CASE WHEN {TEST_SQL} THEN 'test' ELSE 'train' END AS split FROM kept k),
fit AS (SELECT """
    + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}"
        for c in ("area", "bedrooms", "bathrooms", "age_years", "has_garage", "district_code")
    )
    + " FROM coded WHERE split = 'train')",
    "SELECT listing_id, split, "
    + ", ".join(
        f"({c} - m_{c})/s_{c} AS {c}"
        for c in ("area", "bedrooms", "bathrooms", "age_years", "has_garage", "district_code")
    )
    + ", price FROM coded, fit",
    area=6,
    bedrooms=6,
    bathrooms=6,
    age_years=6,
    has_garage=6,
    district_code=6,
    price=6,
)

# --- splits ----------------------------------------------------------------

register(
    "l1_split_exact",
    lambda spark, d: L.split_exact(staged(spark, d), "listing_id").select("listing_id", "split"),
    LISTINGS_SQL,
    """SELECT listing_id, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', listing_id, '42')))
  <= ceil(0.2e0 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM listings""",
)
register(
    "l1_split_by_share",
    lambda spark, d: L.split_by_share(listings(spark, d), "listing_id").select("listing_id", "split"),
    LISTINGS_SQL,
    f"SELECT listing_id, CASE WHEN {TEST_SQL} THEN 'test' ELSE 'train' END AS split FROM listings",
)
register(
    "l2_split_three_ways",
    lambda spark, d: L.split_three_ways(staged(spark, d), "listing_id", exact=True).select("listing_id", "split"),
    LISTINGS_SQL
    + """,
one AS (SELECT listing_id, row_number() OVER (ORDER BY md5(concat_ws('|', listing_id, '42')))
        <= ceil(0.2e0 * count(*) OVER ()) AS t FROM listings),
rest AS (SELECT listing_id, row_number() OVER (ORDER BY md5(concat_ws('|', listing_id, '43')))
        <= ceil(0.2e0 * count(*) OVER ()) AS v FROM one WHERE NOT t)""",
    """SELECT listing_id, CASE WHEN t THEN 'test' WHEN v THEN 'validation' ELSE 'train' END AS split
  FROM one LEFT JOIN rest USING (listing_id)""",
)
register(
    "l3_split_profile",
    lambda spark, d: L.split_profile(L.split_three_ways(listings(spark, d), "listing_id"), "price"),
    SPLIT_SQL,
    "SELECT split, count(*) AS rows, avg(price) AS mean, stddev_samp(price) AS std FROM parts GROUP BY split",
    mean=3,
    std=3,
)
register(
    "l4_folds",
    lambda spark, d: L.with_fold(listings(spark, d), "listing_id", 5).select("listing_id", "fold"),
    LISTINGS_SQL,
    """SELECT listing_id, CAST(CAST('0x' || substr(md5(concat_ws('|', listing_id, '42')),1,8) AS BIGINT) % 5 AS INT) AS fold
  FROM listings""",
)
register(
    "l4_contiguous_folds",
    lambda spark, d: L.with_contiguous_fold(spark.read.parquet(f"{d}/orders.parquet"), 7).select("o_orderkey", "fold"),
    None,
    # The orders lie in the order of their keys.
    """SELECT o_orderkey, CAST(CASE WHEN p < (n % 7) * (n // 7 + 1) THEN p // (n // 7 + 1)
  ELSE n % 7 + (p - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INT) AS fold
  FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p, count(*) OVER () AS n FROM orders)""",
)
_FRACTIONS = [f"{int(round(i / 10 * 16**8)):08x}" for i in range(1, 10)]
register(
    "l5_nested_samples",
    lambda spark, d: L.nested_samples(listings(spark, d), "listing_id").groupBy("smallest_sample").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean_price")
    ),
    LISTINGS_SQL,
    "SELECT CAST(CASE "
    + " ".join(
        f"WHEN substr(md5(concat_ws('|', listing_id, '42')),1,8) < '{edge}' THEN {i}" for i, edge in enumerate(_FRACTIONS, 1)
    )
    + " ELSE 10 END AS INT) AS smallest_sample, count(*) AS n, avg(price) AS mean_price FROM listings GROUP BY 1",
    mean_price=3,
)
register(
    "l6_traffic_assignment",
    lambda spark, d: L.assign_traffic(table(spark, d, "events"), "user_id", {"canary": 0.1, "stable": 0.9}).groupBy("arm").agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("user_id").alias("users")
    ),
    None,
    """SELECT CASE WHEN substr(md5(CAST(user_id AS VARCHAR)),1,8) < '1999999a' THEN 'canary' ELSE 'stable' END AS arm,
  count(*) AS requests, count(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)

# --- joins -----------------------------------------------------------------

register(
    "j1_lookup_join",
    lambda spark, d: P.join_factors(listings(spark, d), DISTRICT_FACTORS).groupBy("district", "factor").agg(
        F.count(F.lit(1)).alias("n")
    ),
    LISTINGS_SQL,
    "SELECT district, multiplier AS factor, count(*) AS n FROM listings GROUP BY ALL",
    factor=4,
)
register(
    "j2_encoder_join",
    lambda spark, d: P.apply_labels(
        gappy_listings(spark, d), P.fit_labels(listings(spark, d), "district"), "district", "district_code", default=-1
    ).groupBy("district", "district_code").agg(F.count(F.lit(1)).alias("n")),
    GAPPY_SQL
    + """,
codes AS (SELECT district AS label, CAST(row_number() OVER (ORDER BY district) - 1 AS INT) AS code
          FROM (SELECT DISTINCT district FROM listings))""",
    """SELECT district, coalesce(code, -1) AS district_code, count(*) AS n
  FROM gappy LEFT JOIN codes ON district = label GROUP BY ALL""",
)


def _feature_target_join(spark, d):
    rows = staged(spark, d)
    x, y = rows.select("listing_id", "area"), rows.select("listing_id", "price")
    return x.join(y, "listing_id").select("listing_id", (F.col("price") / F.col("area")).alias("price_per_area"))


register(
    "j3_feature_target_join",
    _feature_target_join,
    LISTINGS_SQL,
    "SELECT listing_id, price/area AS price_per_area FROM listings",
    price_per_area=6,
)


def _scalar_broadcast(spark, d):
    rows = staged(spark, d)
    mean = scalar(rows.agg(F.avg("price").alias("m")), "m")
    return rows.select("listing_id", (F.col("price") - mean).alias("centred"))


register(
    "j4_scalar_statistic",
    _scalar_broadcast,
    LISTINGS_SQL,
    "SELECT listing_id, price - (SELECT avg(price) FROM listings) AS centred FROM listings",
    centred=4,
)


def _shared(spark, d):
    from gablework.operators.drift import mark_samples

    rows = listings(spark, d)
    old, new = rows.drop("bathrooms").where("has_garage = 1"), rows.drop("area").where("has_garage = 0")
    marked = mark_samples(old, new)
    return marked.groupBy(F.col("_current").alias("is_current")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(",".join(sorted(c for c in marked.columns if c != "_current"))).alias("shared")
    )


register(
    "j5_column_intersection",
    _shared,
    LISTINGS_SQL,
    """SELECT has_garage = 0 AS is_current, count(*) AS n, 'age_years,bedrooms,has_garage,predicted,price' AS shared
  FROM listings GROUP BY 1""",
)
register(
    "j6_two_model_scores",
    lambda spark, d: listings(spark, d).select(
        "listing_id",
        F.col("predicted").alias("model1"),
        P.rule_price(PRICE_WEIGHTS_V2, DISTRICT_FACTORS, absolute=True).alias("model2"),
    ),
    LISTINGS_SQL,
    """SELECT listing_id, predicted AS model1, abs((3000e0*area + 15000e0*bedrooms + 10000e0*bathrooms
  + 25000e0*has_garage - 1000e0*age_years)*multiplier) AS model2 FROM listings""",
    model1=5,
    model2=5,
)
