import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from gablework.functions.stats import chi_square_1df_p, ks_p, normal_quantile, normality_p, pooled_t
from gablework.operators import drift as D
from gablework.operators import evaluate as E
from gablework.operators import gates as G
from gablework.operators import profile as A
from gablework.operators import telemetry as R


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 310.0)], "price double, predicted double")


def test_core_metrics(pairs):
    row = E.evaluate(pairs).first()
    assert row["mse"] == pytest.approx(100) and row["rmse"] == pytest.approx(10) and row["mae"] == pytest.approx(10)
    assert row["r2"] == pytest.approx(0.985) and row["mape"] == pytest.approx(6.111111, abs=1e-6)


def test_r2_of_one_row_or_no_variance(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 3.0), ("b", 3.0, 4.0)], "g string, price double, predicted double")
    assert {r["g"]: r["r2"] for r in E.evaluate(df, ["g"]).collect()} == {"a": None, "b": None}


def test_gate_cases(spark):
    limits = {"min_r2": 0.7, "max_rmse": 50000.0}
    good = spark.createDataFrame([(0.8, 30000.0)], "r2 double, rmse double")
    poor = spark.createDataFrame([(0.5, 60000.0)], "r2 double, rmse double")
    assert G.meets_thresholds(good, limits).first()["passed"]
    assert not G.meets_thresholds(poor, limits).first()["passed"]
    assert G.meets_thresholds(poor, {}).first()["passed"]
    assert not G.meets_thresholds(good, {"max_mae": 1e9}).first()["passed"]


def test_boundary_rows_count_twice(spark):
    rows = [(float(a), 2, 30.0, 100.0 * a, 101.0 * a) for a in range(1, 10)]
    df = spark.createDataFrame(rows, "area double, bedrooms int, age_years double, price double, predicted double")
    counts = {r["scenario"]: r["n"] for r in E.by_scenario(df, 1).collect()}
    assert counts["area_small"] == 3 and counts["area_medium"] == 5 and counts["area_large"] == 3
    assert counts["age_old"] == 9


def test_certificate_clamps_month_end(spark):
    row = spark.createDataFrame(
        [(True, 100.0, 0.9, 100.0, 80.0, 1.0)],
        "ready boolean, readiness_percent double, r2 double, coverage double, within_20_percent double, max_drop double",
    )
    assert G.certificate(row, "2025-08-31").first()["expires_on"] == "2026-02-28"
    assert G.certificate(row.withColumn("ready", F.lit(False)), "2025-08-31").count() == 0


def test_champion_tie_goes_to_baseline(spark):
    df = spark.createDataFrame([("tuned", 0.9), ("baseline", 0.9)], "model string, r2 double")
    assert G.champion(df).first()["model"] == "baseline"


def test_comparison_tie_goes_to_second(spark):
    df = spark.createDataFrame([(0.9, 1.0, 0.9, 1.0)], "r2_1 double, rmse_1 double, r2_2 double, rmse_2 double")
    row = G.compare_models(df).first()
    assert row["better_model"] == "model2" and row["improvement_percent"] == 0


def test_grades(spark):
    df = spark.createDataFrame([(0.95,), (0.85,), (0.7,), (0.6,), (0.5,), (0.1,)], "s double")
    assert [r[0] for r in df.select(G.grade(F.col("s"))).collect()] == ["A+", "A", "B+", "B", "C", "F"]


def test_normal_quantile(spark):
    points = [1e-12, 1e-6, 0.001, 0.07, 0.3, 0.5, 0.8, 0.975, 0.999999]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    for p, (q,) in zip(points, df.select(normal_quantile(F.col("p"))).collect()):
        assert q == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-14)


def test_test_statistics(spark):
    one = spark.range(1)
    f = lambda x: F.lit(float(x))
    row = one.select(
        ks_p(f(0), f(10), f(10)).alias("same"),
        ks_p(f(1), f(100), f(100)).alias("apart"),
        ks_p(f(0.1), f(200), f(200)).alias("middle"),
        normality_p(f(7), f(0), f(0)).alias("few"),
        normality_p(f(1000), f(0), f(0)).alias("normal"),
        chi_square_1df_p(f(3.841458820694124)).alias("chi"),
        pooled_t(f(3), f(2), f(1), f(3), f(4), f(1)).alias("t"),
    ).first()
    assert row["same"] == 1 and row["apart"] < 1e-30
    lam = 0.1 * math.sqrt(100)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert row["middle"] == pytest.approx(series, rel=1e-12)
    assert row["few"] is None and row["normal"] > 0.9
    assert row["chi"] == pytest.approx(0.05, rel=1e-5)
    assert row["t"] == pytest.approx(-2 / math.sqrt(2 / 3))


def test_ks_against_brute_force(spark):
    import random

    rng = random.Random(3)
    old = [round(rng.gauss(0, 1), 2) if rng.random() > 0.33 else 0.0 for _ in range(700)]
    new = [round(rng.gauss(0.3, 1), 2) for _ in range(500)]
    a = spark.createDataFrame([(v,) for v in old], "x double")
    b = spark.createDataFrame([(v, 1) for v in new], "x double, other int")
    row = D.ks_drift(D.mark_samples(a, b), ["x"]).first()
    want = max(
        abs(sum(v <= x for v in old) / len(old) - sum(v <= x for v in new) / len(new)) for x in set(old + new)
    )
    assert row["ks_statistic"] == pytest.approx(want, abs=1e-12)
    assert row["reference_rows"] == 700 and row["current_rows"] == 500


def test_shift_is_zero_on_zero_base(spark):
    df = spark.createDataFrame([(0.0, False), (0.0, False), (5.0, True), (7.0, True)], "x double, _current boolean")
    row = D.moment_shift(df, ["x"]).first()
    assert row["mean_shift"] == 0 and row["std_shift"] == 0


def test_histogram_lists_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,)], "x double")
    bins = {r["bin"]: r["n"] for r in A.histogram(df, F.col("x"), 5).collect()}
    assert bins == {0: 1, 1: 0, 2: 0, 3: 0, 4: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["n"] for r in A.histogram(flat, F.col("x"), 5).collect()) == 2


def test_canary_promotion_and_guard(spark):
    rows = [(f"2024-01-01 00:00:{s:02d}", "canary", 0.2, 0) for s in range(60)]
    df = spark.createDataFrame(rows, "t string, variant string, response_time double, is_error int")
    df = df.withColumn("ts", F.to_timestamp("t"))
    windows = R.windowed_rates(df)
    assert windows.count() == 2
    assert R.canary_decision(windows).first()["decision"] == "promote"
    assert R.first_abort(windows).first()["abort_at"] is None
    armed = df.withColumn("arm", F.lit("A"))
    assert R.sample_guard(R.arm_statistics(armed)).first()["status"] == "insufficient"


def test_ab_winner(spark):
    rows = [("A" if i % 2 else "B", 1.0 + (i % 7) * 0.01 + (0.5 if i % 2 else 0.0), int(i % 50 == 0)) for i in range(4000)]
    df = spark.createDataFrame(rows, "arm string, response_time double, is_error int")
    row = R.ab_decision(df).first()
    assert row["significant"] and row["winner"] == "B" and row["deployed"] == "B"
    assert R.ab_decision(df, minimum=5000).first()["winner"] == "inconclusive"
    independent = R.error_independence(df).first()
    assert independent["chi_square"] == pytest.approx(row["chi_square"])
    assert independent["p_value"] == pytest.approx(row["error_p_value"], rel=1e-4, abs=1e-9)
