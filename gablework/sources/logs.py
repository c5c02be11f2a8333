"""Request and prediction logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LOG_DDL = "timestamp string, level string, client string, variant string, response_time double, is_error int"


def parse_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO time with milliseconds as ``ts``; the text stays."""
    return df.withColumn("ts", F.to_timestamp(column, "yyyy-MM-dd'T'HH:mm:ss.SSS"))


def read_json_lines(spark: SparkSession, path: str, ddl: str = LOG_DDL) -> DataFrame:
    return parse_time(spark.read.schema(ddl).json(path))


def stream_json_lines(spark: SparkSession, path: str, ddl: str = LOG_DDL) -> DataFrame:
    """The same log as a stream of new files."""
    return parse_time(spark.readStream.schema(ddl).json(path))


def audited(row_id: str, rate: float = 0.1) -> Column:
    """Whether a prediction belongs to the audit sample, fixed by its id."""
    from gablework.operators.splits import below_share

    return below_share(F.md5(F.col(row_id).cast("string")), rate)


def append_audit(df: DataFrame, path: str, row_id: str, rate: float = 0.1) -> None:
    """Append the sampled predictions to the audit log."""
    df.where(audited(row_id, rate)).write.mode("append").parquet(path)
