"""Online scoring: requests in, predictions with bounds out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gablework.operators.quality import check_records
from gablework.operators.training import TrainedModel
from gablework.roles import RECORD_RULES
from gablework.session import written
from gablework.sources.manifest import Store

MODEL_VERSION = "1.0.0"
#: What names the current model.
POINTER_DDL = "model_version string, location string"

Scorer = Callable[[DataFrame], DataFrame]


def respond(model: TrainedModel, requests: DataFrame, version: str = MODEL_VERSION) -> DataFrame:
    """Score valid requests with bounds, time and model version.

    Works on a batch and on a stream: it is row-wise only.
    """
    valid = check_records(requests, RECORD_RULES).where("is_valid").drop("is_valid", "reasons")
    return model.score_with_interval(valid).withColumns(
        {"predicted_at": F.current_timestamp(), "model_version": F.lit(version)}
    )


def rejected(requests: DataFrame) -> DataFrame:
    """Requests out of bounds, with the columns at fault."""
    return check_records(requests, RECORD_RULES).where("not is_valid").drop("is_valid")


def run_scoring(model: TrainedModel, requests: DataFrame, path: str, checkpoint: str) -> None:
    """Score a stream of requests, valid and rejected side by side, and stop when done."""

    def write(batch: DataFrame, number: int) -> None:
        respond(model, batch).write.mode("overwrite").parquet(f"{path}/scored/batch_id={number}")
        rejected(batch).write.mode("overwrite").parquet(f"{path}/rejected/batch_id={number}")

    query = (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def rule_response(requests: DataFrame, price: Column, half_width: float) -> DataFrame:
    """Row-wise scoring with a price expression and a fixed half width."""
    return requests.withColumn("prediction", price).withColumns(
        {"lower_bound": F.col("prediction") - half_width, "upper_bound": F.col("prediction") + half_width}
    )


def promote(store: Store, version: str, location: str) -> None:
    """Make a model the one that scoring uses from its next batch on."""
    row = store.spark.createDataFrame([(version, location)], POINTER_DDL)
    store.replace(row.coalesce(1))


def run_promoted_scoring(requests: DataFrame, store: Store, load: Callable[[str], Scorer], path: str, checkpoint: str) -> None:
    """Score a stream by the model that is current when a batch begins, and stop when done.

    ``load`` turns a model's location into a function that scores rows; it is called
    once per change of model.  The choice is written before the batch is
    scored: a batch run again uses the same model and replaces its own rows, so
    no row comes twice and no batch mixes versions.  Rows carry ``model_version``.
    """
    spark = requests.sparkSession
    held: dict[str, Scorer] = {}

    def write(batch: DataFrame, number: int) -> None:
        choice = f"{path}/choices/batch_id={number}"
        if not written(spark, choice):
            store.read().coalesce(1).write.mode("overwrite").parquet(choice)
        # One row by construction.
        chosen = spark.read.schema(POINTER_DDL).parquet(choice).first()
        if chosen["location"] not in held:
            held.clear()
            held[chosen["location"]] = load(chosen["location"])
        scored = held[chosen["location"]](batch).withColumn("model_version", F.lit(chosen["model_version"]))
        scored.write.mode("overwrite").parquet(f"{path}/scored/batch_id={number}")

    query = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
