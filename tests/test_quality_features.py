import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from gablework.operators import features as P
from gablework.operators import quality as Q
from gablework.operators import splits as L
from gablework.roles import FEATURES_9, FEATURES_11, RANGE_RULES, RECORD_RULES, SCHEMA_RULES
from gablework.sources import reports, tables


def test_iqr_drops_the_outlier(spark):
    rows = [(100.0, 200000.0), (200.0, 400000.0), (10000.0, 50000.0), (150.0, 300000.0)]
    df = spark.createDataFrame(rows, "area double, price double")
    kept = Q.clean_by_iqr(df)
    assert kept.count() == 3
    assert kept.agg(F.max("area")).first()[0] < 10000


def test_range_rules_are_strict(spark, tiny):
    edge = tiny.withColumn("area", F.lit(30.0))
    assert Q.clean_by_rules(edge, RANGE_RULES).count() == 0
    assert Q.clean_by_rules(tiny, RANGE_RULES).count() == 5
    gone = tiny.withColumn("age_years", F.lit(None).cast("double"))
    assert Q.clean_by_rules(gone, RANGE_RULES).count() == 0


def test_record_bounds(spark, tiny):
    bad = tiny.limit(1).withColumns({"area": F.lit(-10.0), "bedrooms": F.lit(0)})
    row = Q.check_records(bad, RECORD_RULES).first()
    assert not row["is_valid"] and row["reasons"] == ["area", "bedrooms"]
    valid, rejected = Q.split_valid(tiny.unionByName(bad), RECORD_RULES)
    assert (valid.count(), rejected.count()) == (5, 1)


def test_value_rules_are_ignored_unless_asked(tiny):
    assert "has_garage" not in [r["feature"] for r in Q.rule_scores(tiny, SCHEMA_RULES).collect()]
    assert "has_garage" in [r["feature"] for r in Q.rule_scores(tiny, SCHEMA_RULES, True).collect()]


def test_missing_column_fails_conformance(tiny):
    row = Q.conformance(tiny, SCHEMA_RULES, ["area", "balcony"]).first()
    assert row["overall_score"] == 1.0 and not row["schema_compliance"] and not row["is_valid"]
    assert Q.same_order(tiny.select("area", "price"), ["area", "price"])
    assert not Q.same_order(tiny.select("price", "area"), ["area", "price"])


def test_gate_stops(spark, tiny):
    score = Q.quality_score(tiny, RANGE_RULES)
    Q.require(score, F.col("quality_score") >= 0.95, "quality")
    with pytest.raises(Q.QualityError):
        Q.require(score, F.col("quality_score") > 2, "quality")


def test_imputation_and_profile_with_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,), (10.0,)], "x double")
    assert {r["column"]: r["nulls"] for r in Q.null_profile(df).collect()} == {"x": 2, "(all)": 2}
    assert sorted(r["x"] for r in Q.impute_median(df, ["x"]).collect()) == [1.0, 4.0, 4.0, 4.0, 10.0]
    assert sorted(r["x"] for r in Q.impute_mean(df, ["x"]).collect()) == [1.0, 4.0, 5.0, 5.0, 10.0]


def test_all_missing_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert [r["x"] for r in Q.impute_median(df, ["x", "y"]).collect()] == [None, None]


def test_empty_input(spark, tiny):
    none = tiny.where("area < 0")
    assert Q.removal_report(none, Q.all_hold(RANGE_RULES)).first()["removed_percent"] == 0
    assert Q.rule_scores(none, SCHEMA_RULES).first()["score"] is None


def test_features_and_zero_bedrooms(spark, tiny):
    row = P.derive_features(tiny).where("listing_id = 'd'").first()
    assert row["area_per_room"] == 40.0 and row["bathroom_ratio"] == 0.75
    assert row["age_squared"] == 225.0 and row["total_rooms"] == 7 and row["is_new"] == 0
    assert P.derive_features(tiny.withColumn("bedrooms", F.lit(0))).first()["bathroom_ratio"] is None
    assert len(FEATURES_9) == 9 and len(FEATURES_11) == 11


def test_label_codes(spark, tiny):
    labels = P.fit_labels(tiny, "district")
    assert {r["label"]: r["code"] for r in labels.collect()} == {"Centre": 0, "North": 1, "South": 2}
    other = tiny.withColumn("district", F.lit("West"))
    assert P.apply_labels(other, labels, "district", "code").agg(F.max("code")).first()[0] == 0
    assert P.unknown_labels(other, labels, "district").first()["n"] == 5
    with pytest.raises(PySparkException):
        P.apply_labels(other, labels, "district", "code", unknown="error").collect()
    with pytest.raises(P.NotFittedError):
        P.apply_labels(tiny, None, "district", "code")


def test_scaler_is_population_and_guards_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = P.apply_scaler(df, P.fit_scaler(df, ["x", "k"]), ["x", "k"]).orderBy("x").collect()
    assert out[0]["x"] == pytest.approx(-1.22474487) and out[0]["k"] == 0.0


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(10.0,), (None,), (900.0,)], "x double")
    assert [r[0] for r in df.select(P.clip("x", 30, 500)).collect()] == [30.0, None, 500.0]


def test_folds_and_traffic(spark):
    folds = L.with_fold(spark.range(1000), "id", 5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    arms = L.assign_traffic(spark.range(4000), "id", {"a": 0.5, "b": 0.3, "c": 0.2}).groupBy("arm").count().collect()
    counts = {r["arm"]: r["count"] for r in arms}
    assert counts["a"] > counts["b"] > counts["c"] > 600


def test_csv_round_trip_and_missing_path(spark, tiny, tmp_path):
    columns = ["area", "bedrooms", "bathrooms", "age_years", "has_garage", "district", "price"]
    path = str(tmp_path / "houses")
    tables.write_csv(tiny.select(*columns), path)
    assert sorted(tables.read_csv(spark, path).collect()) == sorted(tiny.select(*columns).collect())
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, str(tmp_path / "absent"))


def test_source_names(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("area,quartos,banheiros,idade,garagem,bairro,preco\n100.5,2,1,5,1,Centro,300000\n")
    row = tables.read_csv(spark, str(path), tables.source_schema()).first()
    assert row.asDict() == {
        "area": 100.5,
        "bedrooms": 2,
        "bathrooms": 1,
        "age_years": 5.0,
        "has_garage": 1,
        "district": "Centro",
        "price": 300000.0,
    }


def test_split_sink_prunes(spark, tiny, tmp_path):
    path = str(tmp_path / "parts")
    tables.write_splits(L.split_by_share(tiny, "listing_id", 0.4), path)
    whole = spark.read.parquet(path).count()
    assert whole == 5
    plan = tables.read_split(spark, path, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_json_documents(spark, tmp_path):
    schema = tmp_path / "schema.json"
    schema.write_text(
        '{"feature_names": ["area"],\n "validation_rules": {"area": {"min": 30, "max": 500}, "garage": {"values": [0, 1]}}}'
    )
    rules = {r["feature"]: (r["low"], r["high"], r["allowed"]) for r in reports.read_rules(spark, str(schema)).collect()}
    assert rules == {"area": (30.0, 500.0, None), "garage": (None, None, [0, 1])}
    metrics = tmp_path / "metrics.json"
    metrics.write_text('{"model_type": "x", "final_rmse": 2.5, "final_r2": NaN, "features": ["a", "b"]}')
    info = reports.read_model_info(spark, str(metrics)).first()
    assert info["rmse"] == 2.5 and info["r2"] != info["r2"] and info["n_features"] == 2
