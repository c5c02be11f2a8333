"""JSON reports: schema documents, metric files, nested results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RULES_DDL = (
    "feature_names array<string>, "
    "validation_rules map<string, struct<min: double, max: double, values: array<int>>>"
)

METRICS_DDL = (
    "model_name string, model_type string, final_rmse double, final_mae double, final_r2 double, "
    "final_mape double, training_samples bigint, test_samples bigint, features array<string>, "
    "feature_importance map<string, double>, training_date string, cv_rmse_mean double"
)


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A pretty-printed document per file; NaN and infinities are accepted."""
    read = spark.read.option("multiLine", True).option("allowNonNumericNumbers", True)
    return read.schema(ddl).json(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a data-schema document: ``feature, low, high, allowed``."""
    doc = read_json(spark, path, RULES_DDL)
    return doc.select(F.explode("validation_rules").alias("feature", "rule")).select(
        "feature", F.col("rule.min").alias("low"), F.col("rule.max").alias("high"), F.col("rule.values").alias("allowed")
    )


def read_expected_features(spark: SparkSession, path: str) -> DataFrame:
    doc = read_json(spark, path, RULES_DDL)
    return doc.select(F.posexplode("feature_names").alias("position", "feature"))


def read_model_info(spark: SparkSession, path: str) -> DataFrame:
    """A metrics file under the short metric names."""
    return read_json(spark, path, METRICS_DDL).selectExpr(
        "model_type",
        "final_rmse AS rmse",
        "final_mae AS mae",
        "final_r2 AS r2",
        "final_mape AS mape",
        "size(features) AS n_features",
        "training_date",
    )


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small report as JSON lines, NULL fields kept."""
    report.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def nest(report: DataFrame, **groups: list[str]) -> DataFrame:
    """Group flat report columns into named structs."""
    used = {c for columns in groups.values() for c in columns}
    rest = [c for c in report.columns if c not in used]
    return report.select(*rest, *[F.struct(*columns).alias(name) for name, columns in groups.items()])
