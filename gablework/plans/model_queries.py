"""Registered queries: drift, telemetry, streams, training, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gablework.functions.metrics import core_metrics
from gablework.jobs.retrain import retrain
from gablework.operators import drift as D
from gablework.operators import evaluate as E
from gablework.operators import features as P
from gablework.operators import robustness as B
from gablework.operators import runs as X
from gablework.operators import splits as L
from gablework.operators import telemetry as R
from gablework.operators import training as T
from gablework.plans.data_queries import CORE_SQL, TEST_SQL, staged
from gablework.plans.listings import LISTINGS_SQL, SERVING_SQL, listings, serving_log, table, to_serving_log
from gablework.plans.registry import register
from gablework.roles import DISTRICT_FACTORS, EDGE_ROWS_WIDE, FEATURES_9, FEATURES_11, PRESETS, PRICE_WEIGHTS_V1
from gablework.session import scratch_path, settings, stage
from gablework.sources import runs as run_store
from gablework.sources.manifest import Store
from gablework.streaming import abort as abort_stream
from gablework.streaming import drift as drift_stream
from gablework.streaming import performance as performance_stream
from gablework.streaming import scoring as scoring_stream
from gablework.streaming import telemetry as stream

# --- drift -----------------------------------------------------------------

WATCHED = ["area", "bedrooms", "age_years", "price"]


def _samples(rows: DataFrame) -> DataFrame:
    """Homes with a garage as reference against those without as current sample."""
    return rows.withColumn(D.CURRENT, F.col("has_garage") == 0)


def _ks_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", max(abs(f0 - f1)) AS ks, max(n0) AS reference_rows, max(n1) AS current_rows,
  count(*) FILTER (WHERE c0 > 0) AS distinct_reference
  FROM (SELECT sum(c0) OVER w * 1e0 / sum(c0) OVER () AS f0, sum(c1) OVER w * 1e0 / sum(c1) OVER () AS f1,
    CAST(sum(c0) OVER () AS BIGINT) AS n0, CAST(sum(c1) OVER () AS BIGINT) AS n1, c0
    FROM (SELECT {c} AS v, count(*) FILTER (WHERE has_garage = 1) AS c0, count(*) FILTER (WHERE has_garage = 0) AS c1
          FROM listings GROUP BY {c}) WINDOW w AS (ORDER BY v))"""


KS_SQL = (
    LISTINGS_SQL
    + ", raw AS ("
    + " UNION ALL ".join(_ks_sql(c) for c in WATCHED)
    + """),
tested AS (SELECT "column", ks AS ks_statistic, reference_rows, current_rows, distinct_reference,
  CASE WHEN ks = 0 THEN 1e0 ELSE greatest(least(2e0 * (SELECT sum((CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END)
    * exp(-2e0*k*k*ks*ks*reference_rows*current_rows/(reference_rows+current_rows))) FROM range(1, 101) t(k)), 1e0), 0e0) END AS p_value
  FROM raw)"""
)
register(
    "d1_ks_drift",
    lambda spark, d: D.ks_drift(_samples(listings(spark, d)), WATCHED),
    KS_SQL,
    """SELECT *, p_value < 0.05e0 AS drift_detected FROM tested""",
    ks_statistic=8,
    p_value=8,
)
register(
    "d2_ks_continuous_only",
    lambda spark, d: D.ks_drift_continuous(_samples(listings(spark, d)), WATCHED),
    KS_SQL,
    """SELECT "column", distinct_reference, CASE WHEN distinct_reference > 10 THEN ks_statistic END AS ks_statistic,
  CASE WHEN distinct_reference > 10 THEN p_value END AS p_value,
  distinct_reference > 10 AND p_value < 0.05e0 AS drift_detected FROM tested""",
    ks_statistic=8,
    p_value=8,
)
SHIFT_SQL = KS_SQL + ", shifts AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", abs(m1-m0)/m0 AS mean_shift, CASE WHEN s0 = 0 THEN 0e0 ELSE abs(s1-s0)/s0 END AS std_shift
  FROM (SELECT avg({c}) FILTER (WHERE has_garage=1) AS m0, avg({c}) FILTER (WHERE has_garage=0) AS m1,
  stddev_samp({c}) FILTER (WHERE has_garage=1) AS s0, stddev_samp({c}) FILTER (WHERE has_garage=0) AS s1 FROM listings)"""
    for c in WATCHED
) + ")"
register(
    "d3_moment_shift",
    lambda spark, d: D.moment_shift(_samples(listings(spark, d)), WATCHED),
    SHIFT_SQL,
    "SELECT * FROM shifts",
    mean_shift=8,
    std_shift=8,
)
_ALARM_SQL = """SELECT "column", mean_shift, std_shift, CASE WHEN distinct_reference > 10 THEN ks_statistic END AS ks_statistic,
  CASE WHEN distinct_reference > 10 THEN p_value END AS p_value,
  mean_shift > 0.1e0 OR std_shift > 0.1e0 OR (distinct_reference > 10 AND p_value < 0.05e0) AS alarm,
  mean_shift > 0.1e0 OR (distinct_reference > 10 AND p_value < 0.05e0) AS noteworthy FROM shifts JOIN tested USING ("column")"""
register(
    "d4_drift_alarms",
    lambda spark, d: D.drift_alarms(_samples(staged(spark, d)), WATCHED),
    SHIFT_SQL,
    _ALARM_SQL,
    mean_shift=8,
    std_shift=8,
    ks_statistic=8,
    p_value=8,
)
register(
    "d5_drifted_count",
    lambda spark, d: D.drifted_count(D.ks_drift(_samples(listings(spark, d)), WATCHED)),
    KS_SQL,
    "SELECT count(*) FILTER (WHERE p_value < 0.05e0) AS drifted, count(*) AS columns FROM tested",
)


def _drift_stream(spark, d):
    """New rows arrive as files; each batch is tested against the whole reference."""
    folder = scratch_path(spark, "incoming")
    rows = staged(spark, d)
    rows.where("has_garage = 0").select(*WATCHED).write.parquet(folder)
    out, checkpoint = scratch_path(spark, "drift"), scratch_path(spark, "drift-state")
    query = drift_stream.start_drift_monitor(
        rows.where("has_garage = 1").select(*WATCHED), stream.read_stream(spark, folder), WATCHED, out, checkpoint, None
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("column", "ks_statistic", "p_value", "drift_detected")


register(
    "d6_drift_monitor_stream",
    _drift_stream,
    KS_SQL,
    'SELECT "column", ks_statistic, p_value, p_value < 0.05e0 AS drift_detected FROM tested',
    ks_statistic=8,
    p_value=8,
)


def _sketch_stream(spark, d):
    """Three batches merged into one sketch; its statistic against the exact one of all rows."""
    folder = scratch_path(spark, "incoming")
    rows = staged(spark, d)
    reference, current = (rows.where(f"has_garage = {i}").select(*WATCHED) for i in (1, 0))
    current.repartition(3).write.parquet(folder)
    out, checkpoint = scratch_path(spark, "sketches"), scratch_path(spark, "sketch-state")
    incoming = stream.read_stream(spark, folder, maxFilesPerTrigger=1)
    drift_stream.start_sketch_monitor(reference, incoming, WATCHED, out, checkpoint, None).awaitTermination()
    tests = spark.read.parquet(f"{out}/tests").drop("batch_id")
    newest = tests.agg(F.max("batch").alias("b")).select("b").scalar()
    exact = D.ks_drift(_samples(rows), WATCHED).select("column", F.col("ks_statistic").alias("exact"))
    # One row per column.
    return tests.where(F.col("batch") == newest).join(F.broadcast(exact), "column").select(
        "column",
        "reference_rows",
        "current_rows",
        (F.abs(F.col("ks_statistic") - F.col("exact")) <= F.col("error_bound")).alias("within_bound"),
    )


register(
    "d6_sketch_monitor_stream",
    _sketch_stream,
    KS_SQL,
    'SELECT "column", reference_rows, current_rows, true AS within_bound FROM tested',
)
PERFORMANCE_SQL = """SELECT *, coalesce("drop" > 0.05e0, false) AS drifted FROM (SELECT *, (baseline_r2 - r2)/baseline_r2 AS "drop" FROM
  (SELECT strftime(listed_on, '%Y') AS period, count(*) AS n,
   1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) AS r2 FROM listings GROUP BY 1),
  (SELECT 1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) AS baseline_r2 FROM listings))"""
register(
    "d7_performance_drift",
    lambda spark, d: D.performance_drift(
        listings(spark, d), F.date_format("listed_on", "yyyy"), "price", "predicted"
    ).withColumnRenamed("drop", "fall"),
    LISTINGS_SQL,
    f'SELECT period, n, r2, baseline_r2, "drop" AS fall, drifted FROM ({PERFORMANCE_SQL})',
    r2=8,
    baseline_r2=8,
    fall=7,
)


#: Rows of a side that arrive between two runs of the stream: what its join holds follows this, not the table.
ARRIVING_ROWS = 2_000_000


#: Only the newest state of the join is ever read again; what came before need not be kept for a hundred batches.
FEW_STATES = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2"}
#: Days between a prediction and its price, at most.
LATEST = 15


def _arrivals(rows: DataFrame, at: str, cuts: list[int], label: str) -> list[DataFrame]:
    """Rows parted by event time, one part after the other and none written: part i ends before day ``cuts[i]``."""
    step = F.lit(0)
    for cut in cuts:
        step = step + (F.unix_seconds(at) >= cut * 86400).cast("int")
    return [rows.alias(label).where(F.coalesce(step, F.lit(0)) == i) for i in range(len(cuts) + 1)]


def _listed_near(cuts: list[int], part: int) -> Column:
    """Whether a row's listing lies where those of a part of either side do: reads few files of rows in order of time."""
    day, near = F.col("listed_on"), F.lit(True)
    if part > 0:
        near = near & (day >= F.date_from_unix_date(F.lit(cuts[part - 1] - LATEST - 1)))
    if part < len(cuts):
        near = near & (day < F.date_from_unix_date(F.lit(cuts[part] + 1)))
    return near if part else near | day.isNull()


def _late_prices(spark, d, at_once: int = ARRIVING_ROWS):
    """Predictions at listing time, prices 0 to 15 days later; those over 10 days late are not waited for.

    Both arrive in order of time, some ``at_once`` rows a run of the stream, so that its
    watermarks drop what is past before more comes.  Shown are windows that are
    closed whatever the order of files: those that start before 1997.  Rows are
    written once, in order of time; what has arrived goes when it was read.
    """
    ordered = listings(spark, d).select("listing_id", "predicted", "price", "listed_on").repartitionByRange("listed_on")
    rows = stage(ordered, "listings")
    sold = F.col("listed_on").cast("timestamp") + F.make_dt_interval(F.conv(F.substring("listing_id", 1, 1), 16, 10).cast("int"))
    steps = -(-rows.count() // at_once)
    shares = [i / steps for i in range(1, steps)]
    days = rows.select(F.unix_date(F.to_date("listed_on")).alias("day"))
    cuts = sorted({int(x) for x in days.approxQuantile("day", shares, 0.001)}) if shares else []
    predictions = rows.select("listed_on", "listing_id", "predicted", F.col("listed_on").cast("timestamp").alias("predicted_at"))
    prices = rows.select("listed_on", "listing_id", "price", sold.alias("sold_at"))
    left, right = scratch_path(spark, "predictions"), scratch_path(spark, "prices")
    out, state = scratch_path(spark, "late"), scratch_path(spark, "late-state")
    sides = zip(_arrivals(predictions, "predicted_at", cuts, "said"), _arrivals(prices, "sold_at", cuts, "paid"))
    for part, (said, paid) in enumerate(sides):
        for side, folder in ((said, left), (paid, right)):
            side.where(_listed_near(cuts, part)).drop("listed_on").write.mode("append").parquet(folder)
        arrived = [stream.read_stream(spark, folder, cleanSource="delete") for folder in (left, right)]
        with settings(spark, FEW_STATES):
            stream.run_once(performance_stream.windowed_fit(performance_stream.joined_late(*arrived, "listing_id")), out, state)
    return _text_time(spark.read.parquet(out).where("window_start < '1997-01-01'"), "window_start")


register(
    "d7_late_prices_stream",
    _late_prices,
    LISTINGS_SQL
    + """, late AS (SELECT *, time_bucket(INTERVAL '90 days', CAST(listed_on AS TIMESTAMP), TIMESTAMP '1970-01-01') AS w FROM listings
  WHERE CAST('0x' || substr(listing_id,1,1) AS INT) <= 10)""",
    """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
  1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) AS r2,
  sqrt(sum((price-predicted)*(price-predicted))/count(*)) AS rmse FROM late WHERE w < TIMESTAMP '1997-01-01' GROUP BY w""",
    r2=7,
    rmse=3,
)


def _retrain_rules(spark, d):
    """Newest year against all rows: R2, share of drifted columns, age of the model."""
    rows = staged(spark, d)
    last = F.to_date(F.lit("1998-01-01"))
    newest = rows.where(F.col("listed_on") >= last)
    r2 = core_metrics()["r2"]
    drifted = D.drifted_count(D.ks_drift(rows.withColumn(D.CURRENT, F.col("listed_on") >= last), ["area", "price"]))
    state = rows.agg(
        r2.alias("baseline_r2"), F.max("listed_on").cast("date").alias("as_of"), (r2 * 1.03).alias("candidate_r2")
    )
    return D.retrain_decision(
        state.withColumn("current_r2", newest.agg(r2.alias("r")).select("r").scalar())
        .withColumn("last_trained", last)
        .withColumn("drift_score", drifted.select((F.col("drifted") / F.col("columns")).alias("s")).scalar())
    )


register(
    "d8_retrain_decision",
    _retrain_rules,
    LISTINGS_SQL
    + """, base AS (SELECT 1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) AS b, max(listed_on) AS as_of FROM listings),
cur AS (SELECT 1e0 - sum((price-predicted)*(price-predicted))/(count(*)*var_pop(price)) AS c FROM listings WHERE listed_on >= DATE '1998-01-01'),
ks AS ("""
    + " UNION ALL ".join(
        f"""SELECT max(abs(f0 - f1)) AS k, max(n0) AS n0, max(n1) AS n1 FROM (SELECT sum(c0) OVER w * 1e0 / sum(c0) OVER () AS f0,
   sum(c1) OVER w * 1e0 / sum(c1) OVER () AS f1, sum(c0) OVER () * 1e0 AS n0, sum(c1) OVER () * 1e0 AS n1
   FROM (SELECT {c} AS v, count(*) FILTER (WHERE listed_on < DATE '1998-01-01') AS c0,
         count(*) FILTER (WHERE listed_on >= DATE '1998-01-01') AS c1 FROM listings GROUP BY {c}) WINDOW w AS (ORDER BY v))"""
        for c in ("area", "price")
    )
    + """),
drift AS (SELECT avg(CASE WHEN p < 0.05e0 THEN 1e0 ELSE 0e0 END) AS s FROM (SELECT greatest(least(2e0*(SELECT sum(
   (CASE WHEN j % 2 = 1 THEN 1e0 ELSE -1e0 END)*exp(-2e0*j*j*k*k*n0*n1/(n0+n1))) FROM range(1,101) t(j)), 1e0), 0e0) AS p FROM ks))""",
    """SELECT DATE '1998-02-01' <= CAST(as_of AS DATE) AS schedule_due, (b-c)/b >= 0.1e0 AS performance_degraded,
  s >= 0.15e0 AS data_drifted, DATE '1998-02-01' <= CAST(as_of AS DATE) OR (b-c)/b >= 0.1e0 OR s >= 0.15e0 AS retrain,
  (b*1.03e0 - c)/c >= 0.02e0 AS promote FROM base, cur, drift""",
)

# --- telemetry, batch ------------------------------------------------------

_RATES_SQL = """count(*) AS requests, CAST(sum(is_error) AS BIGINT) AS errors,
  (count(*) - sum(is_error))*1e0/count(*) AS success_rate, sum(is_error)*1e0/count(*) AS error_rate"""
register(
    "r1_rates",
    lambda spark, d: R.rates_by(serving_log(spark, d), "variant"),
    SERVING_SQL,
    f"SELECT variant, {_RATES_SQL} FROM serving GROUP BY variant",
    success_rate=8,
    error_rate=8,
)


def _text_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def _window_sql(width: str) -> str:
    return f"""windows AS (SELECT time_bucket(INTERVAL '{width}', ts) AS window_start, variant, {_RATES_SQL}
  FROM serving GROUP BY ALL)"""


register(
    "r2_windowed_rates",
    lambda spark, d: _text_time(R.windowed_rates(serving_log(spark, d)).drop("window_end"), "window_start"),
    SERVING_SQL + ", " + _window_sql("30 seconds"),
    "SELECT * REPLACE (strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start) FROM windows",
    success_rate=8,
    error_rate=8,
)
register(
    "r3_canary_abort",
    lambda spark, d: _text_time(R.first_abort(R.windowed_rates(serving_log(spark, d))), "abort_at"),
    SERVING_SQL + ", " + _window_sql("30 seconds"),
    """SELECT strftime(min(window_start), '%Y-%m-%d %H:%M:%S') AS abort_at, count(*) AS bad_windows
  FROM windows WHERE variant = 'canary' AND error_rate > 0.01e0""",
)


def _abort_stream(spark, d):
    out, state = scratch_path(spark, "aborts"), scratch_path(spark, "abort-state")
    abort_stream.run_aborts(_request_stream(spark, d), out, state)
    return _text_time(spark.read.schema(abort_stream.ABORT_DDL).parquet(out).select("variant", "abort_at", "requests"), "abort_at")


register(
    "r3_canary_abort_stream",
    _abort_stream,
    SERVING_SQL + ", " + _window_sql("30 seconds"),
    """SELECT variant, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS abort_at, requests FROM windows
  WHERE variant = 'canary' AND error_rate > 0.01e0
   AND window_start + INTERVAL 30 SECOND <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM serving)
  ORDER BY window_start LIMIT 1""",
)
register(
    "r4_canary_decision",
    lambda spark, d: R.canary_decision(R.windowed_rates(serving_log(spark, d), "1 hour")),
    SERVING_SQL + ", " + _window_sql("1 hour"),
    """SELECT avg(success_rate) AS mean_success, avg(error_rate) AS mean_error, count(*) AS windows,
  CASE WHEN avg(success_rate) >= 0.99e0 AND avg(error_rate) <= 0.01e0 THEN 'promote' ELSE 'rollback' END AS decision
  FROM windows WHERE variant = 'canary'""",
    mean_success=8,
    mean_error=8,
)
_ARMS_SQL = SERVING_SQL + """, arms AS (SELECT count(*) FILTER (WHERE arm='A') AS samples_a, count(*) FILTER (WHERE arm='B') AS samples_b,
  avg(response_time) FILTER (WHERE arm='A') AS mean_a, avg(response_time) FILTER (WHERE arm='B') AS mean_b,
  stddev_samp(response_time) FILTER (WHERE arm='A') AS std_a, stddev_samp(response_time) FILTER (WHERE arm='B') AS std_b,
  sum(is_error) FILTER (WHERE arm='A')*1e0 AS errors_a, sum(is_error) FILTER (WHERE arm='B')*1e0 AS errors_b FROM serving)"""
register(
    "r5_sample_guard",
    lambda spark, d: R.sample_guard(R.arm_statistics(serving_log(spark, d))),
    _ARMS_SQL,
    """SELECT samples_a, samples_b, CAST(1000 AS INT) AS minimum_required,
  CASE WHEN samples_a >= 1000 AND samples_b >= 1000 THEN 'ok' ELSE 'insufficient' END AS status FROM arms""",
)
register(
    "r6_r7_ab_comparison",
    lambda spark, d: R.ab_comparison(R.arm_statistics(serving_log(spark, d))).drop("error_p_value"),
    _ARMS_SQL,
    """SELECT samples_a, samples_b, mean_a, mean_b, (mean_a-mean_b)/sqrt(((samples_a-1)*std_a*std_a + (samples_b-1)*std_b*std_b)
   /(samples_a+samples_b-2)*(1e0/samples_a + 1e0/samples_b)) AS t_statistic,
  errors_a/samples_a AS error_rate_a, errors_b/samples_b AS error_rate_b,
  (samples_a+samples_b)*(errors_a*(samples_b-errors_b) - (samples_a-errors_a)*errors_b)
   *(errors_a*(samples_b-errors_b) - (samples_a-errors_a)*errors_b)
   /(samples_a*1e0*samples_b*(errors_a+errors_b)*(samples_a+samples_b-errors_a-errors_b)) AS chi_square FROM arms""",
    mean_a=6,
    mean_b=6,
    t_statistic=7,
    error_rate_a=8,
    error_rate_b=8,
    chi_square=7,
)
register("r6_ab_decision", lambda spark, d: R.ab_decision(serving_log(spark, d)))
register(
    "r7_error_independence",
    lambda spark, d: R.error_independence(serving_log(spark, d)).select("chi_square"),
    _ARMS_SQL,
    """SELECT (samples_a+samples_b)*(errors_a*(samples_b-errors_b) - (samples_a-errors_a)*errors_b)
   *(errors_a*(samples_b-errors_b) - (samples_a-errors_a)*errors_b)
   /(samples_a*1e0*samples_b*(errors_a+errors_b)*(samples_a+samples_b-errors_a-errors_b)) AS chi_square FROM arms""",
    chi_square=7,
)
register(
    "r9_alerts",
    lambda spark, d: _text_time(R.alerts(serving_log(spark, d), latency_scale=20.0), "window_start"),
    SERVING_SQL
    + """, hours AS (SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  avg(response_time*20e0) AS latency, avg(is_error) AS error_rate FROM serving GROUP BY 1)""",
    """SELECT window_start, 'response_time_ms' AS metric, latency AS value, 1000e0 AS "limit" FROM hours WHERE latency > 1000e0
  UNION ALL SELECT window_start, 'error_rate', error_rate, 0.05e0 FROM hours WHERE error_rate > 0.05e0""",
    value=5,
)
register(
    "r10_rate_violations",
    lambda spark, d: _text_time(R.rate_violations(serving_log(spark, d), limit=1), "window_start"),
    SERVING_SQL,
    """SELECT strftime(time_bucket(INTERVAL '60 seconds', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id, count(*) AS requests
  FROM serving GROUP BY 1, 2 HAVING count(*) > 1""",
)
register(
    "r11_request_rate",
    lambda spark, d: _text_time(R.request_rate(serving_log(spark, d)), "window_start"),
    SERVING_SQL,
    """SELECT strftime(time_bucket(INTERVAL '60 seconds', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests,
  count(*)/60e0 AS requests_per_second, count(*)/60e0/100e0 AS target_share FROM serving GROUP BY 1""",
    requests_per_second=8,
    target_share=8,
)

# --- telemetry, streams ----------------------------------------------------


def _request_stream(spark, d) -> DataFrame:
    return to_serving_log(stream.read_stream(spark, f"{d}/events.parquet"))


def _canary_stream(spark, d):
    out, state = scratch_path(spark, "canary"), scratch_path(spark, "canary-state")
    rates = stream.stream_windowed_rates(_request_stream(spark, d))
    stream.run_once(rates, out, state)
    return _text_time(spark.read.parquet(out).drop("window_end"), "window_start")


register(
    "r2_windowed_rates_stream",
    _canary_stream,
    SERVING_SQL + ", " + _window_sql("30 seconds"),
    """SELECT * REPLACE (strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start) FROM windows
  WHERE window_start + INTERVAL 30 SECOND <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM serving)""",
    success_rate=8,
    error_rate=8,
)


def _ab_stream(spark, d):
    out, state = scratch_path(spark, "ab"), scratch_path(spark, "ab-state")
    stream.run_ab_accumulation(_request_stream(spark, d), out, state)
    return stream.latest_sums(spark, out)


register(
    "r8_ab_accumulation_stream",
    _ab_stream,
    SERVING_SQL,
    """SELECT arm, count(*) AS samples, CAST(sum(is_error) AS BIGINT) AS errors, sum(response_time) AS total,
  sum(response_time*response_time) AS squares FROM serving GROUP BY arm""",
    total=4,
    squares=2,
)


def _audit_stream(spark, d):
    folder = scratch_path(spark, "predictions")
    listings(spark, d).select("listing_id", "predicted").write.parquet(folder)
    out, state = scratch_path(spark, "audit"), scratch_path(spark, "audit-state")
    stream.run_audit(stream.read_stream(spark, folder), out, state, "listing_id")
    return spark.read.parquet(out)


register(
    "s10_audit_log_stream",
    _audit_stream,
    LISTINGS_SQL,
    "SELECT listing_id, predicted FROM listings WHERE substr(md5(listing_id),1,8) < '1999999a'",
    predicted=6,
)

# --- training and scoring --------------------------------------------------

SMALL = {"n_estimators": 12, "max_depth": 8}


def _parts(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = stage(L.split_by_share(listings(spark, d), "listing_id"), "parts")
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def _test_metrics(model: T.TrainedModel, test: DataFrame) -> DataFrame:
    return E.evaluate(model.score(test), predicted="prediction")


def _forest(spark, d):
    fit, test = _parts(spark, d)
    return _test_metrics(T.train(fit, **SMALL), test).withColumn("good", F.col("r2") >= 0.7)


register("t1_random_forest", _forest)


def _boosting(spark, d):
    fit, test = _parts(spark, d)
    model = T.train(fit, "gradient_boosting", n_estimators=8, max_depth=5, subsample=0.9, learning_rate=0.3)
    return _test_metrics(model, test).withColumn("good", F.col("r2") >= 0.7)


register("t2_gradient_boosting", _boosting)


def _both_algorithms(spark, d):
    fit, test = _parts(spark, d)
    out = None
    for name, settings in (("random_forest", {"n_estimators": 5, "max_depth": 6}), ("gradient_boosting", {"n_estimators": 5})):
        one = _test_metrics(T.train(fit, name, **settings), test).withColumn("algorithm", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


register("t3_algorithm_switch", _both_algorithms)


def _grid_search(spark, d):
    fit, _ = _parts(spark, d)
    few = {"n_estimators": [5, 10], "max_depth": [5, 8]}
    return T.search(fit, "random_forest", T.grid("random_forest", few), folds=3).table


register("t4_grid_search", _grid_search)


def _trial_search(spark, d):
    """Seeded trials, with the tree counts scaled down to keep the check short."""
    fit, _ = _parts(spark, d)
    trials = [{**t, "n_estimators": t["n_estimators"] // 25, "max_depth": min(t["max_depth"] or 8, 8)} for t in T.draw_trials("random_forest", 3)]
    return T.search(fit, "random_forest", trials, folds=2).table


register("t5_trial_search", _trial_search)


def _whole_grid(spark, d):
    """All 81 combinations of the forest grid, each on five held-out folds.

    The errors themselves depend on the fit, so the table says which were scored,
    on how many rows, and whether the best is the least.
    """
    fit, _ = _parts(spark, d)
    table = T.search_nested(fit, "random_forest").table
    least = table.agg(F.min("cv_rmse").alias("least")).select("least").scalar()
    return table.select(
        "candidate", "settings", "cell", "scored_rows", (F.col("cv_rmse") > 0).alias("scored"), (~F.col("best") | (F.col("cv_rmse") == least)).alias("ranked")
    )


register(
    "t4_whole_grid",
    _whole_grid,
    LISTINGS_SQL,
    f"""SELECT CAST(27*n + 9*d + 3*l + f AS INT) AS candidate,
  'max_depth=' || ['10', '20', 'None'][d + 1] || ', max_features=' || ['sqrt', 'log2', 'None'][f + 1]
  || ', min_samples_leaf=' || [1, 2, 4][l + 1] || ', n_estimators=' || [100, 200, 300][n + 1] AS settings,
  CAST(9*d + 3*l + f AS INT) AS cell,
  (SELECT count(*) FROM listings WHERE NOT ({TEST_SQL})) AS scored_rows, true AS scored, true AS ranked
  FROM range(3) a(n), range(3) b(d), range(3) c(l), range(3) e(f)""",
)


def _fifty_trials(spark, d):
    """The whole budget of 50 seeded trials over the search ranges, each on five held-out folds."""
    fit, _ = _parts(spark, d)
    table = T.search_nested(fit, "random_forest", T.draw_trials("random_forest", 50)).table
    return table.groupBy("scored_rows").agg(
        F.count("cv_rmse").alias("trials"), F.count_if("best").alias("winners"), (F.max_by("best", -F.col("cv_rmse"))).alias("least_wins")
    )


register(
    "t5_fifty_trials",
    _fifty_trials,
    LISTINGS_SQL,
    f"""SELECT count(*) AS scored_rows, CAST(50 AS BIGINT) AS trials, CAST(1 AS BIGINT) AS winners, true AS least_wins
  FROM listings WHERE NOT ({TEST_SQL})""",
)


def _search_choice(spark, d):
    """Which search each environment gets for the rows at hand."""
    rows = listings(spark, d).agg(F.count(F.lit(1)).alias("rows"))
    choices = [
        (env, T.search_method("random_forest", p["max_trials"]) if p["tuning"] else "none", p["num_trees"], p["folds"])
        for env, p in PRESETS.items()
    ]
    frame = spark.createDataFrame(choices, "environment string, method string, trees int, folds int")
    return frame.withColumn("rows", rows.select("rows").scalar())


register(
    "t6_t20_search_choice_per_preset",
    _search_choice,
    LISTINGS_SQL,
    """SELECT environment, CASE WHEN NOT tuning THEN 'none' WHEN trials > 9 THEN 'trials' ELSE 'grid' END AS method,
  CAST(trees AS INT) AS trees, CAST(folds AS INT) AS folds, (SELECT count(*) FROM listings) AS rows
  FROM (VALUES ('development', false, 10, 50, 3), ('staging', true, 25, 100, 5), ('production', true, 50, 200, 5))
  p(environment, tuning, trials, trees, folds)""",
)
register(
    "t7_cross_validation",
    lambda spark, d: T.summarise_folds(T.cross_validate(staged(spark, d), k=3, n_estimators=5, max_depth=6)),
)


def _importance(spark, d):
    fit, _ = _parts(spark, d)
    return T.train(fit, features=FEATURES_11, **SMALL).importance(spark)


register("t8_feature_importance", _importance)


def _batch_scores(spark, d):
    fit, test = _parts(spark, d)
    return T.train(fit, **SMALL).score(test).select("listing_id", "prediction")


register("t9_batch_scoring", _batch_scores)


def _single(spark, d):
    """The first listing by id scored as one record and within the batch."""
    fit, test = _parts(spark, d)
    model = T.train(fit, **SMALL)
    row = test.orderBy("listing_id").first()
    one = model.score_one(
        spark, **{c: row[c] for c in ("area", "bedrooms", "bathrooms", "age_years", "has_garage", "district")}
    )
    batch = model.score(test).where(F.col("listing_id") == row["listing_id"])
    return batch.select("listing_id", "prediction", F.lit(one).alias("single"), (F.abs(F.col("prediction") - one) < 1e-6).alias("same"))


register("t10_single_record_scoring", _single)
register(
    "t10_single_equals_batch",
    lambda spark, d: _single(spark, d).select("listing_id", "same"),
    LISTINGS_SQL,
    f"SELECT min(listing_id) AS listing_id, true AS same FROM listings WHERE {TEST_SQL}",
)


def _scoring_stream(spark, d):
    fit, test = _parts(spark, d)
    model = T.train(fit, **SMALL)
    folder, out, state = (scratch_path(spark, n) for n in ("requests", "scored", "scored-state"))
    # Every eleventh of the digest space asks for an impossible area.
    broken = F.when(L.below_share(F.md5("listing_id"), 1 / 11), -F.col("area")).otherwise(F.col("area"))
    test.withColumn("area", broken).write.parquet(folder)
    scoring_stream.run_scoring(model, stream.read_stream(spark, folder), out, state)
    scored = spark.read.parquet(f"{out}/scored").select("listing_id", "prediction", F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{out}/rejected").select(
        "listing_id", F.lit(None).cast("double").alias("prediction"), F.array_join("reasons", ",").alias("reasons")
    )
    return scored.unionByName(refused)


register("t11_scoring_stream", _scoring_stream)


def _rule_stream(spark, d):
    """Online scoring with the price rule, so that SQL can state the result."""
    folder, out, state = (scratch_path(spark, n) for n in ("requests", "ruled", "ruled-state"))
    rows = staged(spark, d)
    rows.select("listing_id", "area", "bedrooms", "bathrooms", "age_years", "has_garage", "district").write.parquet(folder)
    half = rows.agg((F.stddev_samp(F.col("price") - F.col("predicted")) * 1.96).alias("h")).first()["h"]
    price = P.rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=50_000)
    stream.run_once(scoring_stream.rule_response(stream.read_stream(spark, folder), price, half), out, state)
    return spark.read.parquet(out).select("listing_id", "prediction", "lower_bound", "upper_bound")


register(
    "t11_rule_scoring_stream",
    _rule_stream,
    LISTINGS_SQL + ", h AS (SELECT stddev_samp(price-predicted)*1.96e0 AS half FROM listings)",
    "SELECT listing_id, predicted AS prediction, predicted - half AS lower_bound, predicted + half AS upper_bound FROM listings, h",
    prediction=3,
    lower_bound=3,
    upper_bound=3,
)


def _promoted_scoring(spark, d):
    """A price rule at an outdated price level scores half of the listings; its level is then corrected, and if better promoted for the rest."""
    folder, out, state = (scratch_path(spark, n) for n in ("arriving", "promoted", "promoted-state"))
    rows, early = staged(spark, d), F.col("listing_id") < "8"
    seen = rows.where(early)
    asked = ["listing_id", "area", "bedrooms", "bathrooms", "age_years", "has_garage", "district"]
    store = Store(spark, scratch_path(spark, "models"))

    def saved(level: DataFrame) -> str:
        path = scratch_path(spark, "level")
        level.write.parquet(path)
        return path

    def load(path: str) -> scoring_stream.Scorer:
        level = spark.read.parquet(path).first()[0]
        rule = P.rule_price(PRICE_WEIGHTS_V1, DISTRICT_FACTORS, floor=50_000)
        return lambda batch: batch.select("listing_id", (rule * level).alias("prediction"))

    def run(part: DataFrame) -> None:
        part.select(*asked).write.mode("append").parquet(folder)
        scoring_stream.run_promoted_scoring(stream.read_stream(spark, folder), store, load, out, state)

    scoring_stream.promote(store, "1", saved(spark.range(1).select(F.lit(0.8).alias("level"))))
    run(seen)
    level = saved(seen.agg((F.sum("price") / F.sum("predicted")).alias("level")))
    now = spark.read.parquet(level).first()[0]
    both = seen.withColumns({"old": F.col("predicted") * 0.8, "new": F.col("predicted") * now})
    fits = both.agg(core_metrics("price", "old")["r2"].alias("current_r2"), core_metrics("price", "new")["r2"].alias("candidate_r2"))
    decision = D.retrain_decision(
        fits.select(
            "*", F.col("current_r2").alias("baseline_r2"), F.lit(0.0).alias("drift_score"), F.current_date().alias("as_of"), F.current_date().alias("last_trained")
        )
    )
    if decision.first()["promote"]:
        scoring_stream.promote(store, "2", level)
    run(rows.where(~early))
    return spark.read.parquet(f"{out}/scored").select("listing_id", "model_version", "prediction")


register(
    "t11_promoted_scoring_stream",
    _promoted_scoring,
    LISTINGS_SQL
    + """, early AS (SELECT *, sum(price) OVER () / sum(predicted) OVER () AS level FROM listings WHERE listing_id < '8'),
fits AS (SELECT max(level) AS level, 1e0 - sum((price-predicted*0.8e0)*(price-predicted*0.8e0))/(count(*)*var_pop(price)) AS r2,
  1e0 - sum((price-predicted*level)*(price-predicted*level))/(count(*)*var_pop(price)) AS better FROM early),
chosen AS (SELECT level, (better - r2)/r2 >= 0.02e0 AS promote FROM fits)""",
    """SELECT listing_id, CASE WHEN listing_id >= '8' AND promote THEN '2' ELSE '1' END AS model_version,
  predicted * CASE WHEN listing_id >= '8' AND promote THEN level ELSE 0.8e0 END AS prediction FROM listings, chosen""",
    prediction=3,
)


def _tree_interval(spark, d):
    fit, test = _parts(spark, d)
    scored = T.train(fit, **SMALL).score_with_interval(test)
    return scored.select("listing_id", "prediction", "lower_bound", "upper_bound")


register("t12_tree_interval", _tree_interval)


def _node_interval(spark, d):
    """Bounds from the node table: every tree votes, their mean is the prediction, the bounds hold it."""
    fit, test = _parts(spark, d)
    scored = T.train(fit, **SMALL).score_with_interval(test)
    half = (F.col("upper_bound") - F.col("lower_bound")) / 2
    return scored.select(
        "listing_id",
        "n_trees",
        (F.abs(F.col("tree_mean") - F.col("prediction")) < 1e-6 * F.col("prediction")).alias("mean_agrees"),
        (F.abs(half - 1.96 * F.col("tree_std")) < 1e-6 * F.col("prediction")).alias("bounds_agree"),
    )


register(
    "t12_node_interval",
    _node_interval,
    LISTINGS_SQL,
    f"SELECT listing_id, CAST({SMALL['n_estimators']} AS BIGINT) AS n_trees, true AS mean_agrees, true AS bounds_agree FROM listings WHERE {TEST_SQL}",
)


def _saved_model(spark, d):
    """Largest difference between a model and its reloaded copy over the test rows."""
    fit, test = _parts(spark, d)
    model = T.train(fit, **SMALL)
    path = scratch_path(spark, "model")
    model.save(path)
    again = T.TrainedModel.load(path)
    a = model.score(test).select("listing_id", F.col("prediction").alias("a"))
    b = again.score(test).select("listing_id", F.col("prediction").alias("b"))
    return a.join(b, "listing_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("largest"))


register(
    "t14_save_and_load",
    _saved_model,
    LISTINGS_SQL,
    f"SELECT count(*) AS n, 0e0 AS largest FROM listings WHERE {TEST_SQL}",
)
register(
    "t18_learning_curve",
    lambda spark, d: T.learning_curve(staged(spark, d), [0.1, 0.4, 1.0], k=2, n_estimators=5, max_depth=6),
)
register(
    "t21_batch_envelope",
    lambda spark, d: R.batch_envelope(
        listings(spark, d).select("predicted", F.substring("listing_id", 1, 3).alias("batch_id")), "batch_id", 15
    ),
    LISTINGS_SQL,
    """SELECT substr(listing_id,1,3) AS batch_id, count(*) AS batch_size, count(*) <= 15 AS within_limit
  FROM listings GROUP BY 1""",
)


def _model_noise(spark, d):
    fit, test = _parts(spark, d)
    model = T.train(fit, features=FEATURES_9, **SMALL)
    return B.noise_effect(test, model.score, row_id="listing_id")


register("e27_noise_effect_forest", _model_noise)


def _model_edges(spark, d):
    fit, _ = _parts(spark, d)
    model = T.train(fit, **SMALL)
    # The first label of the fitted rows, without another pass over them; none if no row has one.
    place = next(iter(model.categories), None)
    return B.judge_edges(model.score(B.edge_frame(fit, EDGE_ROWS_WIDE, place)))


register("e28_edge_cases_forest", _model_edges)


def _retrain_job(spark, d):
    _, metrics = retrain(listings(spark, d), "development", n_estimators=8, max_depth=8)
    return metrics


register("d9_retrain_job", _retrain_job)

# --- runs ------------------------------------------------------------------

RUN_TIME = 1_752_418_679_943


def _run_metrics(spark, d) -> DataFrame:
    """One run per district: its metrics as run rows."""
    by_district = E.evaluate(listings(spark, d), ["district"])
    return X.metric_rows(by_district, "district", ["rmse", "mae", "r2", "mape"], RUN_TIME)


def _stored_runs(spark, d) -> DataFrame:
    path = scratch_path(spark, "runs")
    run_store.write_metrics(_run_metrics(spark, d), path)
    run_store.write_metrics(_run_metrics(spark, d), path)  # lines may be repeated
    return run_store.read_metrics(spark, path, run_store.PARTITION_LAYOUT)


_RUNS_SQL = LISTINGS_SQL + f", m AS (SELECT district, {CORE_SQL} FROM listings GROUP BY district)"
_LONG_RUNS_SQL = " UNION ALL ".join(f"SELECT district AS run_id, '{k}' AS key, {k} AS value FROM m" for k in ("rmse", "mae", "r2", "mape"))


register(
    "s5_run_scan",
    lambda spark, d: _stored_runs(spark, d).select("run_id", "key", "value"),
    _RUNS_SQL,
    _LONG_RUNS_SQL,
    value=3,
)
register(
    "x1_log_run",
    lambda spark, d: _run_metrics(spark, d),
    _RUNS_SQL,
    f"SELECT run_id, key, CAST({RUN_TIME} AS BIGINT) AS ts_ms, value, CAST(0 AS INT) AS step FROM ({_LONG_RUNS_SQL})",
    value=3,
)


def _run_importance(spark, d):
    fit, _ = _parts(spark, d)
    return X.importance_rows(T.train(fit, **SMALL).importance(spark), "forest", RUN_TIME)


register("x1_log_importance", _run_importance)
register(
    "x2_prefix_metrics",
    lambda spark, d: X.with_prefix(_run_metrics(spark, d).where("run_id = 'ASIA'"), "test_").unionByName(
        X.with_prefix(_run_metrics(spark, d).where("run_id = 'EUROPE'"), "val_")
    ).select("key", "value"),
    _RUNS_SQL,
    f"""SELECT CASE run_id WHEN 'ASIA' THEN 'test_' ELSE 'val_' END || key AS key, value FROM ({_LONG_RUNS_SQL})
  WHERE run_id IN ('ASIA', 'EUROPE')""",
    value=3,
)
register(
    "x3_leaderboard",
    lambda spark, d: X.leaderboard(_run_metrics(spark, d), ["r2", "rmse"], "r2"),
    _RUNS_SQL,
    "SELECT district AS run_id, r2, rmse FROM m",
    r2=8,
    rmse=3,
)


def _run_durations(spark, d):
    """Orders per customer taken as runs: first and last order date as times."""
    orders = table(spark, d, "orders")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    runs = orders.groupBy(F.col("o_custkey").cast("string").alias("run_id")).agg(
        F.min("o_orderpriority").alias("run_name"),
        F.min(millis).alias("start_ms"),
        F.max(millis).alias("end_ms"),
        F.when(F.bool_or(F.col("o_orderstatus") == "F"), "FINISHED").otherwise("FAILED").alias("status"),
    )
    return X.durations(runs)


register(
    "x4_run_durations",
    _run_durations,
    None,
    """SELECT CAST(o_custkey AS VARCHAR) AS run_id, min(o_orderpriority) AS run_name,
  CASE WHEN bool_or(o_orderstatus = 'F') THEN 'FINISHED' ELSE 'FAILED' END AS status,
  (epoch_ms(max(o_orderdate)) - epoch_ms(min(o_orderdate)))/1000e0 AS seconds,
  bool_or(o_orderstatus = 'F') AS usable FROM orders GROUP BY o_custkey""",
    seconds=3,
)
