"""Tree ensembles on Spark ML: fitting, search, cross-validation, scoring."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gablework.functions.metrics import core_metrics, named
from gablework.operators import binned, forests, grown
from gablework.operators.features import NotFittedError, derive_features
from gablework.operators.splits import below_share, digest, with_fold
from gablework.roles import FEATURES_9, FEATURES_11, PRESETS

# Parameter grids of the two algorithms.
FOREST_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [10, 20, None],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2", None],
}
BOOSTING_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.1, 0.2],
    "subsample": [0.8, 0.9, 1.0],
}
# Search ranges (low, high, step or "log" or "real") and choices.
FOREST_RANGES = {
    "n_estimators": (50, 300, 50),
    "max_depth": [10, 20, None],
    "min_samples_leaf": (1, 10, 1),
    "max_features": ["sqrt", "log2", None],
}
BOOSTING_RANGES = {
    "n_estimators": (50, 300, 50),
    "max_depth": (3, 10, 1),
    "learning_rate": (0.01, 0.3, "log"),
    "subsample": (0.6, 1.0, "real"),
}
GRIDS = {"random_forest": FOREST_GRID, "gradient_boosting": BOOSTING_GRID}
RANGES = {"random_forest": FOREST_RANGES, "gradient_boosting": BOOSTING_RANGES}

#: Settings that trees on binned rows know.
BINNED = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy"}
DEEPEST = 30  # Spark's limit, stands for "no limit"
SEED = 42


def spark_params(algorithm: str, settings: dict) -> dict:
    """Translate the usual parameter names to those of Spark ML.

    ``min_samples_split`` has no counterpart and is ignored.
    """
    forest = algorithm == "random_forest"
    out = {}
    for name, value in settings.items():
        if name == "n_estimators":
            out["numTrees" if forest else "maxIter"] = int(value)
        elif name == "max_depth":
            out["maxDepth"] = DEEPEST if value is None else int(value)
        elif name == "min_samples_leaf":
            out["minInstancesPerNode"] = int(value)
        elif name == "max_features":
            out["featureSubsetStrategy"] = "all" if value is None else str(value)
        elif name == "learning_rate":
            out["stepSize"] = float(value)
        elif name == "subsample":
            out["subsamplingRate"] = float(value)
        elif name == "random_state":
            out["seed"] = int(value)
        elif name not in ("min_samples_split", "n_jobs"):
            raise ValueError(f"unknown parameter: {name}")
    return out


def make_estimator(algorithm: str, target: str = "price", **settings) -> Estimator:
    """The estimator of an algorithm by name."""
    common = {"featuresCol": "features", "labelCol": target, "seed": SEED}
    if algorithm == "random_forest":
        # All features at every split unless asked otherwise.  Each row's node in every tree is kept from level to
        # level: the trees are the same, without a walk from the root of each at every level.
        base = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all", "cacheNodeIds": True}
        return RandomForestRegressor(**{**common, **base, **spark_params(algorithm, settings)})
    if algorithm == "gradient_boosting":
        base = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}
        return GBTRegressor(**{**common, **base, **spark_params(algorithm, settings)})
    raise ValueError(f"unsupported algorithm: {algorithm}")


def preparation(features: Sequence[str] = FEATURES_9, category: str = "district", unknown: str = "keep") -> list:
    """Stages from raw listing columns (plus derived ones) to the feature vector.

    Codes follow the sorted labels.  ``unknown="error"`` rejects new labels.
    """
    indexer = StringIndexer(
        inputCol=category, outputCol="district_code", stringOrderType="alphabetAsc", handleInvalid=unknown
    )
    return [indexer, VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")]


class TrainedModel:
    """A fitted preparation and ensemble, applied to frames of listings."""

    def __init__(self, fitted: PipelineModel | None = None, features: Sequence[str] = FEATURES_9):
        self.fitted = fitted
        self.features = tuple(features)

    def _need(self) -> PipelineModel:
        if self.fitted is None:
            raise NotFittedError("model not trained; train it or load one first")
        return self.fitted

    @property
    def ensemble(self) -> Model:
        return self._need().stages[-1]

    @property
    def categories(self) -> list[str]:
        """The labels seen in training, in order of their bytes as Spark's own minimum has them."""
        return sorted(self._need().stages[0].labels, key=lambda label: label.encode("utf-8", "surrogatepass"))

    def prepare(self, df: DataFrame) -> DataFrame:
        """Vectorised features; a label never seen in training gets code 0."""
        indexer, assembler = self._need().stages[0], self._need().stages[1]
        coded = indexer.transform(derive_features(df))
        unseen = float(len(indexer.labels))
        code = F.when(F.col("district_code") == unseen, 0.0).otherwise(F.col("district_code"))
        return assembler.transform(coded.withColumn("district_code", code))

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; whole partitions are scored in the JVM."""
        return self.ensemble.transform(self.prepare(df)).drop("features")

    def score_with_interval(self, df: DataFrame, width: float = 1.96) -> DataFrame:
        """Prediction with the spread over the trees: their number, mean and population deviation."""
        return forests.spread_of_trees(self.ensemble, self.prepare(df), width)

    def score_one(self, spark: SparkSession, **listing) -> float:
        """Score a single listing."""
        schema = (
            "area double, bedrooms int, bathrooms int, age_years double, has_garage int, district string"
        )
        names = ("area", "bedrooms", "bathrooms", "age_years", "has_garage", "district")
        row = [float(listing[n]) if n in ("area", "age_years") else listing[n] for n in names]
        return self.score(spark.createDataFrame([tuple(row)], schema)).first()["prediction"]

    def importance(self, spark: SparkSession) -> DataFrame:
        """Features with their importance and rank; one row per feature."""
        weights = self.ensemble.featureImportances.toArray().tolist()
        ranked = sorted(zip(self.features, weights), key=lambda pair: (-pair[1], pair[0]))
        rows = [(name, float(w), i) for i, (name, w) in enumerate(ranked, 1)]
        return spark.createDataFrame(rows, "feature string, importance double, rank int")

    def save(self, path: str) -> None:
        self._need().write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> TrainedModel:
        fitted = PipelineModel.load(path)
        return cls(fitted, fitted.stages[1].getInputCols())


def train(
    df: DataFrame,
    algorithm: str = "random_forest",
    features: Sequence[str] = FEATURES_9,
    target: str = "price",
    **settings,
) -> TrainedModel:
    """Fit preparation and ensemble on the cluster."""
    stages = [*preparation(features), make_estimator(algorithm, target, **settings)]
    return TrainedModel(Pipeline(stages=stages).fit(derive_features(df)), features)


def fit_dummy(features: Sequence[str] = FEATURES_9) -> TrainedModel:
    """An untrained model: every use raises :class:`NotFittedError`."""
    return TrainedModel(None, features)


# --- search ----------------------------------------------------------------


def grid(algorithm: str, choices: dict[str, list] | None = None) -> list[dict]:
    """All combinations of a parameter grid."""
    choices = choices or GRIDS[algorithm]
    return [dict(zip(choices, combo)) for combo in itertools.product(*choices.values())]


def draw_trials(algorithm: str, trials: int, seed: int = SEED) -> list[dict]:
    """A seeded random list of parameter settings within the search ranges."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        trial = {}
        for name, span in RANGES[algorithm].items():
            if isinstance(span, list):
                trial[name] = rng.choice(span)
            elif span[2] == "log":
                trial[name] = math.exp(rng.uniform(math.log(span[0]), math.log(span[1])))
            elif span[2] == "real":
                trial[name] = rng.uniform(span[0], span[1])
            else:
                trial[name] = rng.randrange(span[0], span[1] + 1, span[2])
        drawn.append(trial)
    return drawn


def search_method(algorithm: str, max_trials: int) -> str:
    """Trials if the budget exceeds three times the first grid list, else the grid."""
    first = next(iter(GRIDS[algorithm].values()))
    return "trials" if max_trials > 3 * len(first) else "grid"


@dataclass
class SearchResult:
    model: TrainedModel
    best: dict
    best_mse: float
    table: DataFrame


def search(
    df: DataFrame,
    algorithm: str = "random_forest",
    candidates: Sequence[dict] | None = None,
    folds: int = 5,
    features: Sequence[str] = FEATURES_9,
    target: str = "price",
    row_id: str = "listing_id",
    parallelism: int = 4,
) -> SearchResult:
    """Cross-validated search for the lowest mean squared error, refit on all rows.

    Folds come from the row id, so they are the same on every run.  The
    features are prepared once and kept for all fits; a fold is a filter on
    them, not another copy.
    """
    candidates = list(candidates or grid(algorithm))
    prep = Pipeline(stages=preparation(features)).fit(derive_features(df))
    prepared = with_fold(prep.transform(derive_features(df)), row_id, folds).select("features", target, "fold")
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        present = {r["fold"] for r in prepared.select("fold").distinct().collect()}
        for fold in range(folds):
            if fold not in present or len(present) < 2:
                raise ValueError(f"fold {fold} has no rows to fit or to score")
        evaluator = RegressionEvaluator(labelCol=target, metricName="mse")

        def one(fold: int, at: int) -> list[tuple]:
            model = make_estimator(algorithm, target, **candidates[at]).fit(prepared.where(F.col("fold") != fold))
            return [(at, evaluator.evaluate(model.transform(prepared.where(F.col("fold") == fold))))]

        tasks = [lambda f=fold, i=i: one(f, i) for fold in range(folds) for i in range(len(candidates))]
        errors: dict[int, list[float]] = {}
        for i, mse in _side_by_side(tasks, parallelism):
            errors.setdefault(i, []).append(mse)
        scores = [sum(errors[i]) / folds for i in range(len(candidates))]
        at = min(range(len(scores)), key=scores.__getitem__)
        best = make_estimator(algorithm, target, **candidates[at]).fit(prepared)
    finally:
        prepared.unpersist()
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in sorted(settings.items())), float(math.sqrt(m)), i == at)
        for i, (settings, m) in enumerate(zip(candidates, scores))
    ]
    table = df.sparkSession.createDataFrame(rows, "candidate int, settings string, cv_rmse double, best boolean")
    model = TrainedModel(PipelineModel(stages=[*prep.stages, best]), features)
    return SearchResult(model, candidates[at], float(scores[at]), table)


def cells(candidates: Sequence[dict]) -> dict[tuple, list[int]]:
    """Candidates that differ in the number of trees only: their other settings, and the places of all of them."""
    found: dict[tuple, list[int]] = {}
    for i, settings in enumerate(candidates):
        rest = tuple(sorted(((k, v) for k, v in settings.items() if k != "n_estimators"), key=lambda pair: pair[0]))
        found.setdefault(rest, []).append(i)
    return found


def search_nested(
    df: DataFrame,
    algorithm: str = "random_forest",
    candidates: Sequence[dict] | None = None,
    folds: int = 5,
    validated: Sequence[int] | None = None,
    features: Sequence[str] = FEATURES_9,
    target: str = "price",
    row_id: str = "listing_id",
    parallelism: int = 4,
) -> SearchResult:
    """As :func:`search`, with one fit per fold for all candidates that differ in the number of trees only.

    The largest ensemble of each such cell is fitted; its first trees are the
    smaller ones.  For boosting they are exactly the ensembles that would be fitted
    alone; for a forest they are forests of the same distribution.  The trees of
    forests are fitted on binned rows, counted once for all cells (:mod:`binned`), and
    grown side by side where a task can take those rows (:mod:`grown`); the best candidate is refitted on the rows themselves.  ``validated``
    names the folds to hold out, all by default.  ``table`` has a row per
    candidate with its cell, the rows it was scored on and its error.
    """
    candidates = list(candidates or grid(algorithm))
    found = cells(candidates)
    prep = Pipeline(stages=preparation(features)).fit(derive_features(df))
    prepared = with_fold(prep.transform(derive_features(df)), row_id, folds).select("features", target, "fold")
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)

    # Other settings of a forest (say, a share of rows for each tree) are left to Spark's own bags.
    counted = algorithm == "random_forest" and all(set(spark_params(algorithm, c)) <= BINNED for c in candidates)
    if counted:
        wide = with_fold(prep.transform(derive_features(df)), row_id, folds)
        most = max(int(c["n_estimators"]) for c in candidates)
        table = binned.binned(wide, features, target, row_id, most, SEED, "fold").persist(StorageLevel.MEMORY_AND_DISK)
        asked = {"maxDepth": 10, "minInstancesPerNode": 1, "featureSubsetStrategy": "all"}
        wanted = [{**asked, **spark_params(algorithm, c)} for c in candidates]
        settings = [tuple(p[k] for k in ("numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy")) for p in wanted]
        rows_counted = table.count()
    together = counted and rows_counted <= grown.WHOLE_ROWS and all(p[3] in grown.LOOKED_AT for p in settings)
    held_out = range(folds) if validated is None else validated

    def side_by_side() -> list[tuple]:
        places = grown.slots(settings)
        found = {(r["fold"], r["slot"]): r for r in grown.errors(table, settings, held_out, SEED, rows_counted).collect()}
        return [
            (i, r["n"] if r else 0, r[f"mse_{p[0]}"] if r else None)
            for fold in held_out
            for i, p in enumerate(settings)
            for r in [found.get((fold, places.index(p[1:])))]
        ]

    bags = binned.bag_sizes(table, most, "fold") if counted and not together else {}

    def one(fold: int, places: list[int]) -> list[tuple]:
        sizes = sorted({int(candidates[i]["n_estimators"]) for i in places})
        largest = {**candidates[places[0]], "n_estimators": sizes[-1]}
        if counted:
            _, depth, least, strategy = settings[places[0]]
            rest = table.where(F.col("fold") != fold)
            totals = [sum(held[t] for f, held in bags.items() if f != fold) for t in range(sizes[-1])]
            trees = [binned.fit_tree(rest, t, total, depth, least, strategy, SEED) for t, total in enumerate(totals)]
            row = binned.prefix_errors(trees, table.where(F.col("fold") == fold), sizes).first()
        else:
            fitted = make_estimator(algorithm, target, **largest).fit(prepared.where(F.col("fold") != fold))
            held = prepared.where(F.col("fold") == fold)
            row = forests.prefix_errors(fitted, held, target, sizes, algorithm == "random_forest").first()
        return [(i, row["n"], row[f"mse_{int(candidates[i]['n_estimators'])}"]) for i in places]

    try:
        tasks = [lambda f=fold, p=places: one(f, p) for fold in held_out for places in found.values()]
        scored = side_by_side() if together else _side_by_side(tasks, parallelism)
        errors: dict[int, list[tuple[int, float]]] = {}
        for i, n, mse in scored:
            errors.setdefault(i, []).append((n, mse))
        # Without a row in any held-out fold a candidate has no error and never wins.
        means = [
            sum(e for _, e in errors[i]) / len(errors[i]) if all(e is not None for _, e in errors[i]) else math.inf
            for i in range(len(candidates))
        ]
        at = min(range(len(means)), key=means.__getitem__)
        if counted:
            table.unpersist()
        best = make_estimator(algorithm, target, **candidates[at]).fit(prepared)
    finally:
        prepared.unpersist()
    cell_of = {i: c for c, places in enumerate(found.values()) for i in places}
    rows = [
        (
            i,
            ", ".join(f"{k}={v}" for k, v in sorted(settings.items())),
            cell_of[i],
            sum(n for n, _ in errors[i]),
            math.sqrt(means[i]) if math.isfinite(means[i]) else None,
            i == at,
        )
        for i, settings in enumerate(candidates)
    ]
    schema = "candidate int, settings string, cell int, scored_rows bigint, cv_rmse double, best boolean"
    result = df.sparkSession.createDataFrame(rows, schema)
    model = TrainedModel(PipelineModel(stages=[*prep.stages, best]), features)
    return SearchResult(model, candidates[at], means[at], result)


# --- cross-validation and learning curve -----------------------------------


def _side_by_side(tasks: Sequence[Callable[[], list[tuple]]], width: int) -> list[tuple]:
    """Run independent fits next to each other; the cluster does the work."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        return [row for rows in pool.map(lambda task: task(), tasks) for row in rows]


def cross_validate(
    df: DataFrame,
    algorithm: str = "random_forest",
    k: int = 5,
    features: Sequence[str] = FEATURES_9,
    target: str = "price",
    row_id: str = "listing_id",
    parallelism: int = 4,
    **settings,
) -> DataFrame:
    """Metrics of every fold, long: ``fold, metric, value``."""
    prep = Pipeline(stages=preparation(features)).fit(derive_features(df))
    prepared = with_fold(prep.transform(derive_features(df)), row_id, k).select("features", target, "fold")
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    metrics = core_metrics(target, "prediction")

    def one(fold: int) -> list[tuple]:
        model = make_estimator(algorithm, target, **settings).fit(prepared.where(F.col("fold") != fold))
        row = model.transform(prepared.where(F.col("fold") == fold)).agg(*named(metrics, "mse", "mae", "r2")).first()
        values = {"mse": row["mse"], "mae": row["mae"], "r2": row["r2"]}
        return [(fold, name, value) for name, value in values.items()]

    try:
        rows = _side_by_side([lambda f=f: one(f) for f in range(k)], parallelism)
    finally:
        prepared.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, metric string, value double")


def summarise_folds(folds: DataFrame) -> DataFrame:
    """Summary of cross-validation in one row.

    ``cv_rmse_mean`` is the root of the mean MSE and ``cv_rmse_std`` the root
    of the deviation of the MSE, as callers expect; ``cv_rmse_spread`` is the
    deviation of the fold RMSEs themselves.
    """

    def of(metric: str) -> Column:
        return F.when(F.col("metric") == metric, F.col("value"))

    return folds.agg(
        F.sqrt(F.avg(of("mse"))).alias("cv_rmse_mean"),
        F.sqrt(F.stddev_pop(of("mse"))).alias("cv_rmse_std"),
        F.stddev_pop(F.sqrt(of("mse"))).alias("cv_rmse_spread"),
        F.avg(of("r2")).alias("cv_r2_mean"),
        F.stddev_pop(of("r2")).alias("cv_r2_std"),
        F.avg(of("mae")).alias("cv_mae_mean"),
    )


def learning_curve(
    df: DataFrame,
    fractions: Iterable[float] | None = None,
    algorithm: str = "random_forest",
    k: int = 5,
    features: Sequence[str] = FEATURES_9,
    target: str = "price",
    row_id: str = "listing_id",
    parallelism: int = 4,
    **settings,
) -> DataFrame:
    """Train and validation RMSE per sample size, mean and deviation over folds.

    Samples are nested by the digest of the id; the last column grades the gap
    between validation and training error.
    """
    fractions = list(fractions or [i / 10 for i in range(1, 11)])
    prep = Pipeline(stages=preparation(features)).fit(derive_features(df))
    prepared = with_fold(prep.transform(derive_features(df)), row_id, k).select(
        "features", target, "fold", digest(row_id, "size").alias("_digest")
    )
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    error = core_metrics(target, "prediction")["rmse"]

    def one(fraction: float, fold: int) -> list[tuple]:
        used = prepared.where((F.col("fold") != fold) & below_share(F.col("_digest"), fraction))
        held = prepared.where(F.col("fold") == fold)
        model = make_estimator(algorithm, target, **settings).fit(used)
        seen = model.transform(used).agg(F.count(F.lit(1)).alias("n"), error.alias("e")).first()
        new = model.transform(held).agg(error.alias("e")).first()
        return [(float(fraction), fold, seen["n"], seen["e"], new["e"])]

    try:
        tasks = [lambda f=f, i=i: one(f, i) for f in fractions for i in range(k)]
        rows = _side_by_side(tasks, parallelism)
    finally:
        prepared.unpersist()
    frame = df.sparkSession.createDataFrame(
        rows, "fraction double, fold int, rows bigint, train_rmse double, validation_rmse double"
    )
    gap = F.col("validation_rmse") - F.col("train_rmse")
    return (
        frame.groupBy("fraction")
        .agg(
            F.avg("rows").alias("rows"),
            F.avg("train_rmse").alias("train_rmse"),
            F.stddev_pop("train_rmse").alias("train_rmse_std"),
            F.avg("validation_rmse").alias("validation_rmse"),
            F.stddev_pop("validation_rmse").alias("validation_rmse_std"),
        )
        .withColumn("gap", gap)
        .withColumn("balance", F.when(gap < 10_000, "balanced").when(gap < 20_000, "moderate").otherwise("overfit"))
    )


def preset(environment: str) -> dict:
    """Training and gate settings of an environment."""
    if environment not in PRESETS:
        raise ValueError(f"unknown environment: {environment}")
    return dict(PRESETS[environment])


def preset_table(spark: SparkSession) -> DataFrame:
    names = list(next(iter(PRESETS.values())))
    rows = [(env, *[values[n] for n in names]) for env, values in PRESETS.items()]
    kinds = {bool: "boolean", int: "int", float: "double"}
    first = next(iter(PRESETS.values()))
    schema = "environment string, " + ", ".join(f"{n} {kinds[type(first[n])]}" for n in names)
    return spark.createDataFrame(rows, schema)


FEATURE_SETS = {"nine": FEATURES_9, "eleven": FEATURES_11}
