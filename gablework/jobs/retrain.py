"""Periodic retraining as a batch job.

    spark-submit --py-files ... gablework/jobs/retrain.py TABLE MODEL_DIR [ENVIRONMENT]

Reads a parquet table of listings, cleans it, splits it, trains with the preset
of the environment, evaluates on the held-out rows and stores the model only if
it meets the gates.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from gablework.operators.evaluate import evaluate
from gablework.operators.gates import meets_thresholds
from gablework.operators.quality import clean_by_rules, quality_score, require
from gablework.operators.splits import split_by_share
from gablework.operators.training import TrainedModel, draw_trials, grid, preset, search, search_method, train
from gablework.roles import QUALITY_THRESHOLD, RANGE_RULES
from gablework.session import configure, stage


def retrain(listings: DataFrame, environment: str = "production", algorithm: str = "random_forest", **settings) -> tuple[TrainedModel, DataFrame]:
    """The trained model and its one-row test metrics with ``passed``."""
    chosen = preset(environment)
    require(
        quality_score(listings, RANGE_RULES),
        F.col("quality_score") >= QUALITY_THRESHOLD,
        "data quality below threshold",
    )
    parts = stage(split_by_share(clean_by_rules(listings, RANGE_RULES), "listing_id"), "retrain")
    fit_rows = parts.where("split = 'train'")
    if chosen["tuning"] and not settings:
        if search_method(algorithm, chosen["max_trials"]) == "trials":
            candidates = draw_trials(algorithm, chosen["max_trials"])
        else:
            candidates = grid(algorithm)
        model = search(fit_rows, algorithm, candidates, chosen["folds"]).model
    else:
        model = train(fit_rows, algorithm, **{"n_estimators": chosen["num_trees"], **settings})
    metrics = evaluate(model.score(parts.where("split = 'test'")), predicted="prediction")
    limits = {"min_r2": chosen["min_r2"], "max_rmse": chosen["max_rmse"]}
    passed = meets_thresholds(metrics, limits).select("passed").scalar()
    return model, metrics.withColumn("passed", passed)


def main(arguments: list[str]) -> None:
    source, target = arguments[0], arguments[1]
    environment = arguments[2] if len(arguments) > 2 else "production"
    spark = configure(SparkSession.builder.appName("gablework-retrain").getOrCreate())
    model, metrics = retrain(spark.read.parquet(source), environment)
    result = metrics.first()
    if not result["passed"]:
        raise SystemExit(f"model not stored, gates failed: {result.asDict()}")
    model.save(target)


if __name__ == "__main__":
    main(sys.argv[1:])
