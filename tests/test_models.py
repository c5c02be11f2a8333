import hashlib
import math

import pytest
from pyspark.ml import Pipeline, tuning
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from gablework.jobs.retrain import retrain
from gablework.operators import evaluate as E
from gablework.operators import forests
from gablework.operators import robustness as B
from gablework.operators import splits as L
from gablework.operators import training as T
from gablework.operators.features import NotFittedError, derive_features
from gablework.plans import model_queries as M
from gablework.plans.listings import listings
from gablework.session import stage


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    rows = stage(L.split_by_share(listings(spark, sf_dir), "listing_id"))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


@pytest.fixture(scope="module")
def forest(parts):
    return T.train(parts[0], n_estimators=10, max_depth=8)


def test_tiny_training(spark, tiny):
    model = T.train(tiny, n_estimators=5)
    metrics = E.evaluate(model.score(tiny), predicted="prediction").first()
    assert metrics["n"] == 5 and metrics["r2"] >= 0
    assert model.importance(spark).count() == 9
    assert model.score(tiny).agg(F.min("prediction")).first()[0] > 0
    one = dict(area=120, bedrooms=3, bathrooms=2, age_years=5, has_garage=1)
    assert model.score_one(spark, district="Centre", **one) > 0
    assert model.score_one(spark, district="Nowhere", **one) == model.score_one(spark, district="Centre", **one)


def test_untrained_model_refuses(tiny):
    with pytest.raises(NotFittedError):
        T.fit_dummy().score(tiny)


def test_quality_on_listings(forest, parts):
    assert E.evaluate(forest.score(parts[1]), predicted="prediction").first()["r2"] > 0.7


def test_interval_is_that_of_the_trees(forest, parts):
    few = parts[1].orderBy("listing_id").limit(40)
    rows = forest.score_with_interval(few).collect()
    prepared = forest.prepare(few)
    votes = {r["listing_id"]: [] for r in rows}
    for tree in forest.ensemble.trees:
        for r in tree.transform(prepared).select("listing_id", "prediction").collect():
            votes[r["listing_id"]].append(r["prediction"])
    for r in rows:
        v = votes[r["listing_id"]]
        mean = sum(v) / len(v)
        std = (sum((x - mean) ** 2 for x in v) / len(v)) ** 0.5
        assert r["prediction"] == pytest.approx(mean)
        assert r["upper_bound"] - r["prediction"] == pytest.approx(1.96 * std, abs=1e-6)


def test_save_and_load(spark, forest, parts, tmp_path):
    path = str(tmp_path / "model")
    forest.save(path)
    again = T.TrainedModel.load(path)
    few = parts[1].orderBy("listing_id").limit(20)
    a = [r["prediction"] for r in forest.score(few).orderBy("listing_id").collect()]
    assert a == [r["prediction"] for r in again.score(few).orderBy("listing_id").collect()]
    assert again.features == forest.features


def test_algorithms_and_parameters():
    with pytest.raises(ValueError):
        T.make_estimator("linear")
    with pytest.raises(ValueError):
        T.spark_params("random_forest", {"speed": 1})
    translated = T.spark_params("random_forest", {"max_depth": None, "max_features": None, "min_samples_split": 5})
    assert translated == {"maxDepth": 30, "featureSubsetStrategy": "all"}
    assert len(T.grid("random_forest")) == 81 and len(T.grid("gradient_boosting")) == 81
    assert T.search_method("random_forest", 9) == "grid" and T.search_method("random_forest", 10) == "trials"
    assert T.draw_trials("gradient_boosting", 5) == T.draw_trials("gradient_boosting", 5)
    assert all(0.01 <= t["learning_rate"] <= 0.3 for t in T.draw_trials("gradient_boosting", 20))


def test_search_picks_lowest_error(parts):
    result = T.search(parts[0], candidates=[{"n_estimators": 2, "max_depth": 1}, {"n_estimators": 4, "max_depth": 6}], folds=2)
    assert result.best["max_depth"] == 6
    assert [r["best"] for r in result.table.orderBy("candidate").collect()] == [False, True]


def test_cross_validation(parts):
    folds = T.cross_validate(parts[0], k=3, n_estimators=3, max_depth=5)
    assert folds.count() == 9
    row = T.summarise_folds(folds).first()
    assert row["cv_rmse_mean"] > 0 and row["cv_r2_mean"] > 0.5


def test_learning_curve_grows(parts):
    rows = T.learning_curve(parts[0], [0.2, 1.0], k=2, n_estimators=3, max_depth=5).orderBy("fraction").collect()
    assert rows[0]["rows"] < rows[1]["rows"] and rows[1]["balance"] in ("balanced", "moderate", "overfit")


def test_noise_draws_look_normal(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    row = B.add_digest_normals(df, "k", F.lit(1), 5).agg(
        F.avg("_z0").alias("m"), F.stddev("_z4").alias("s"), F.corr("_z0", "_z1").alias("c")
    ).first()
    assert abs(row["m"]) < 0.03 and abs(row["s"] - 1) < 0.03 and abs(row["c"]) < 0.03


def test_noise_words_are_whole_numbers(spark):
    df = spark.createDataFrame([(h,) for h in ("00000000", "7fffffff", "80000000", "ffffffff", "0000000f", None)], "h string")
    got = [r["v"] for r in df.select(B.whole_number(F.col("h")).alias("v")).collect()]
    assert got == [0.0, 2.0**31 - 1, 2.0**31, 2.0**32 - 1, 15.0, None]
    # A draw by hand: the first two words of the digest.
    one = B.add_digest_normals(spark.createDataFrame([("a",)], "k string"), "k", F.lit(50), 1)
    digest = hashlib.md5(b"a|50|0").hexdigest()
    u, v = ((int(digest[i : i + 8], 16) + 1.0) / (2**32 + 1) for i in (0, 8))
    assert one.first()["_z0"] == pytest.approx(math.sqrt(-2 * math.log(u)) * math.cos(2 * math.pi * v), rel=1e-12)
    noisy = B.add_digest_normals(spark.range(3).selectExpr("string(id) AS k"), "k", F.lit(50), 1)
    plan = noisy._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") == plan.count("as bigint) as double)") > 0


def test_categories_are_those_of_the_rows(tiny):
    more = tiny.limit(2).withColumn("district", F.lit("\u00c9st")).unionAll(tiny.limit(2).withColumn("district", F.lit(None).cast("string")))
    rows = tiny.unionAll(more)
    model = T.train(rows, n_estimators=1, max_depth=1)
    wanted = [r["district"] for r in rows.where("district IS NOT NULL").select("district").distinct().orderBy("district").collect()]
    assert model.categories == wanted and model.categories[0] == rows.agg(F.min("district")).first()[0]


def test_edge_query_makes_no_further_pass(spark, sf_dir, monkeypatch):
    """Once the forest is fitted nothing more is asked of its rows."""
    train = T.train

    def refuse(*_):
        raise AssertionError("the fitted rows were read once more")

    def then_no_more(fit, **settings):
        model = train(fit, **settings)
        for action in ("first", "head", "take", "agg"):
            monkeypatch.setattr(type(fit), action, refuse)
        return model

    monkeypatch.setattr(T, "train", then_no_more)
    judged = M._model_edges(spark, sf_dir).collect()
    assert len(judged) == 5 and all(r["prediction"] > 0 for r in judged)


def test_retrain_job(spark, sf_dir, forest):
    model, metrics = retrain(listings(spark, sf_dir), "development", n_estimators=5, max_depth=7)
    row = metrics.first()
    assert row["passed"] and row["r2"] > 0.7 and model.features == forest.features


def test_prefix_is_the_forest_of_its_trees(spark, parts):
    """Errors of the first trees against those trees scored one by one; boosting against a shorter fit."""
    from gablework.operators import forests

    fit, test = parts
    few = test.orderBy("listing_id").limit(300)
    for name, averaged in (("random_forest", True), ("gradient_boosting", False)):
        model = T.train(fit, name, n_estimators=6, max_depth=4)
        prepared = stage(model.prepare(few).select("listing_id", "features", "price"))
        got = forests.prefix_errors(model.ensemble, prepared, "price", [1, 3, 6], averaged).first()
        weights = model.ensemble.treeWeights
        said = [
            {r["listing_id"]: r["prediction"] for r in tree.transform(prepared).select("listing_id", "prediction").collect()}
            for tree in model.ensemble.trees
        ]
        price = {r["listing_id"]: r["price"] for r in prepared.collect()}
        for size in (1, 3, 6):
            scale = size if averaged else 1
            errors = [(p - sum(w * s[i] for w, s in list(zip(weights, said))[:size]) / scale) ** 2 for i, p in price.items()]
            assert got[f"mse_{size}"] == pytest.approx(sum(errors) / len(errors))
        if not averaged:
            short = T.train(fit, name, n_estimators=3, max_depth=4)
            mse = E.evaluate(short.score(few), predicted="prediction").first()["mse"]
            assert got["mse_3"] == pytest.approx(mse)


def test_nested_search_equals_search_for_boosting(parts):
    fit = parts[0].where(L.below_share(F.md5("listing_id"), 0.2))
    candidates = [{"n_estimators": n, "max_depth": d} for n in (2, 4) for d in (2, 3)]
    nested = T.search_nested(fit, "gradient_boosting", candidates, folds=2)
    plain = T.search(fit, "gradient_boosting", candidates, folds=2)
    assert nested.best == plain.best and nested.best_mse == pytest.approx(plain.best_mse)
    a = {r["candidate"]: r["cv_rmse"] for r in nested.table.collect()}
    assert a == pytest.approx({r["candidate"]: r["cv_rmse"] for r in plain.table.collect()})
    assert {r["cell"] for r in nested.table.collect()} == {0, 1}
    assert nested.model.score(fit).count() == plain.model.score(fit).count()


def test_grid_falls_into_cells():
    candidates = T.grid("random_forest")
    found = T.cells(candidates)
    assert len(candidates) == 81 and len(found) == 27 and {len(p) for p in found.values()} == {3}
    assert len(T.cells(T.grid("gradient_boosting"))) == 27


def test_importance_from_nodes(forest):
    from gablework.operators import forests

    found = {r["feature"]: r["importance"] for r in forests.importance(forests.node_table(forest.ensemble)).collect()}
    wanted = forest.ensemble.featureImportances.toArray()
    assert found == pytest.approx({i: w for i, w in enumerate(wanted) if w > 0})


def test_deep_forest_has_its_votes_from_the_table(spark, parts):
    """Depth 30: far more leaves than the driver should hold, and the same bounds as from the single trees."""
    model = T.train(parts[0], n_estimators=8, max_depth=30, min_samples_leaf=1)
    few = parts[1].orderBy("listing_id").limit(25)
    prepared = model.prepare(few)
    said = {}
    for tree in model.ensemble.trees:
        for r in tree.transform(prepared).select("listing_id", "prediction").collect():
            said.setdefault(r["listing_id"], []).append(r["prediction"])
    for r in model.score_with_interval(few).collect():
        v = said[r["listing_id"]]
        mean = sum(v) / len(v)
        assert r["n_trees"] == 8 and r["tree_mean"] == pytest.approx(mean)
        assert r["tree_std"] == pytest.approx((sum((x - mean) ** 2 for x in v) / len(v)) ** 0.5, abs=1e-6)


def test_nested_search_of_forests_counts_rows_once(parts, monkeypatch):
    """All cells of a forest are fitted on one table of binned rows; the rows themselves are fitted once, by the best."""
    fit = parts[0].where(L.below_share(F.md5("listing_id"), 0.3))
    made, make = [], T.make_estimator
    monkeypatch.setattr(T, "make_estimator", lambda *a, **k: (made.append(k), make(*a, **k))[1])
    candidates = [{"n_estimators": n, "max_depth": d, "min_samples_leaf": 2} for n in (2, 4) for d in (2, 5)]
    found = T.search_nested(fit, "random_forest", candidates, folds=2)
    assert made == [found.best]
    rows = {r["candidate"]: r for r in found.table.collect()}
    assert {r["scored_rows"] for r in rows.values()} == {fit.count()}
    plain = {r["candidate"]: r["cv_rmse"] for r in T.search(fit, "random_forest", candidates, folds=2).table.collect()}
    # Not the same draws, but forests of the same kind.
    for i, r in rows.items():
        assert r["cv_rmse"] == pytest.approx(plain[i], rel=0.15)
    assert rows[1]["cv_rmse"] < rows[0]["cv_rmse"]


def test_binned_tree_equals_spark_on_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    from gablework.operators import binned

    rows = spark.range(4000).selectExpr("id", "0 AS part", "double(id % 7) AS a", "double(id * 31 % 11 * 5 % 11) AS b", "double(id * 17 % 23) AS c")
    rows = rows.withColumn("y", F.abs(F.col("a") - 3) * 9 + F.col("b") * F.col("c") + F.pmod(F.xxhash64("id"), F.lit(5)))
    rows = rows.withColumn("b", F.col("b").alias("b", metadata={"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(11)], "name": "b"}}))
    table = binned.binned(rows, ["a", "b", "c"], "y", "id", 2, 1, "part")
    sums = table.agg(F.sum("n").alias("n"), F.sum("sum").alias("y"), F.count(F.lit(1)).alias("groups")).first()
    assert (sums["n"], sums["y"]) == (4000, rows.agg(F.sum("y")).first()[0]) and sums["groups"] == 7 * 11 * 23
    # With bags of every row once, the tree and its error are those of Spark's tree on the rows.
    once = table.withColumns({"w": F.array(F.col("n").cast("double")), "s": F.array("sum")})
    for depth, least in ((4, 1), (6, 40), (3, 2001)):
        tree = binned.fit_tree(once, 0, 4000.0, depth, least, "all", 42)
        got = binned.prefix_errors([tree], once, [1]).first()
        vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
        own = DecisionTreeRegressor(labelCol="y", maxDepth=depth, minInstancesPerNode=least).fit(vectors)
        wanted = own.transform(vectors).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
        assert got["n"] == 4000 and got["mse_1"] == pytest.approx(wanted)
        assert tree.trees[0].numNodes == own.numNodes


def test_bags_and_bins(spark):
    from gablework.operators import binned

    drawn = spark.range(20000).select(*[c.alias(f"w{t}") for t, c in enumerate(binned.bag_counts("id", 42, 2))])
    got = drawn.agg(F.avg("w0"), F.var_pop("w0"), F.avg((F.col("w0") == 0).cast("int")), F.corr("w0", "w1")).first()
    assert got[0] == pytest.approx(1, abs=0.03) and got[1] == pytest.approx(1, abs=0.05)
    assert got[2] == pytest.approx(0.3679, abs=0.015) and abs(got[3]) < 0.03
    rows = spark.range(10000).selectExpr("double(id) AS many", "double(id % 3) AS few", "1 AS one")
    cuts = binned.cut_points(rows, ["many", "few", "one"])
    assert len(cuts["many"]) == 31 and cuts["few"] == [0.5, 1.5] and cuts["one"] == []


def test_kept_node_ids_change_no_tree(parts):
    prepared = Pipeline(stages=T.preparation()).fit(derive_features(parts[0])).transform(derive_features(parts[0]))
    kept = T.make_estimator("random_forest", n_estimators=4, max_depth=6)
    assert kept.getCacheNodeIds()
    walked = kept.copy({kept.cacheNodeIds: False})
    trees = [e.fit(prepared).toDebugString.split("\n", 1)[1] for e in (kept, walked)]
    assert trees[0] == trees[1]


def test_search_copies_no_fold(parts, monkeypatch):
    def refuse(_):
        raise AssertionError("the rows of a fold were kept once more")

    monkeypatch.setattr(type(parts[0]), "cache", refuse)
    candidates = [{"n_estimators": 2, "max_depth": d} for d in (2, 4)]
    found = T.search(parts[0], "random_forest", candidates, folds=2)
    monkeypatch.undo()
    prepared = Pipeline(stages=T.preparation()).fit(derive_features(parts[0])).transform(derive_features(parts[0]))
    plain = T.make_estimator("random_forest", n_estimators=2)
    errors = tuning.CrossValidator(
        estimator=plain,
        estimatorParamMaps=[{plain.maxDepth: d} for d in (2, 4)],
        evaluator=RegressionEvaluator(labelCol="price", metricName="mse"),
        numFolds=2,
        foldCol="fold",
    ).fit(L.with_fold(prepared, "listing_id", 2).select("features", "price", "fold")).avgMetrics
    assert found.best_mse == pytest.approx(min(errors))
    assert [r["cv_rmse"] ** 2 for r in found.table.orderBy("candidate").collect()] == pytest.approx(errors)
    with pytest.raises(ValueError):
        T.search(parts[0].limit(1), "random_forest", candidates, folds=2)


def test_looked_up_votes_equal_joined_ones(forest, parts, monkeypatch):
    columns = ["prediction", "n_trees", "tree_mean", "tree_std", "lower_bound", "upper_bound"]
    few = parts[1].where("listing_id < '2'")
    few = few.unionAll(few.limit(3))
    looked_up = forest.score_with_interval(few)
    monkeypatch.setattr(forests, "LOOKUP_BYTES", -1)
    joined = forest.score_with_interval(few)
    assert looked_up.columns == joined.columns
    rows, others = (sorted(tuple(r) for r in df.select("listing_id", *columns).collect()) for df in (looked_up, joined))
    assert len(rows) == len(others) and all(a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-9) for a, b in zip(rows, others))


def test_forests_grown_together_are_those_grown_alone(spark):
    """Same bags, same trees: errors of all sizes, depths and leaves as from Spark's trees one by one."""
    from gablework.operators import binned, grown

    rows = spark.range(3000).selectExpr("id", "int(id * 13 % 3) AS fold", "double(id % 7) AS a", "double(id * 31 % 11 * 5 % 11) AS b", "double(id * 17 % 23) AS c")
    rows = rows.withColumn("y", F.abs(F.col("a") - 3) * 9 + F.col("b") * F.col("c") + F.pmod(F.xxhash64("id"), F.lit(50)) + F.rand(3))
    rows = rows.withColumn("b", F.col("b").alias("b", metadata={"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(11)], "name": "b"}}))
    table = binned.binned(rows, ["a", "b", "c"], "y", "id", 7, 1, "fold")
    candidates = [(n, depth, least, "all") for n in (2, 7) for depth, least in ((2, 1), (9, 1), (5, 12))]
    got = {(r["fold"], r["slot"]): r for r in grown.errors(table, candidates, [0, 2], 42, table.count()).collect()}
    places = grown.slots(candidates)
    assert set(got) == {(fold, slot) for fold in (0, 2) for slot in range(3)}
    bags = binned.bag_sizes(table, 7, "fold")
    for slot, (depth, least, look) in enumerate(places):
        totals = [bags[1][t] + bags[2][t] for t in range(7)]
        trees = [binned.fit_tree(table.where("fold <> 0"), t, total, depth, least, look, 42) for t, total in enumerate(totals)]
        wanted = binned.prefix_errors(trees, table.where("fold = 0"), [2, 7]).first()
        assert got[0, slot]["n"] == wanted["n"] == rows.where("fold = 0").count()
        # Far down two features may gain the same, up to rounding.
        near = 0.01 if depth == 9 else 1e-9
        assert (got[0, slot]["mse_2"], got[0, slot]["mse_7"]) == pytest.approx((wanted["mse_2"], wanted["mse_7"]), rel=near)
    # Some features a split: other trees, of the same use.
    some = grown.errors(table, [(7, 9, 2, "sqrt"), (7, 9, 2, "log2")], [0, 1, 2], 42, table.count()).collect()
    assert len(some) == 6 and all(0 < r["mse_7"] < 2 * got[0, 0]["mse_7"] for r in some)


def test_searches_run_their_whole_budget(spark, sf_dir, monkeypatch):
    asked = []

    def note(fit, algorithm, candidates=None, folds=5, validated=None):
        asked.append((algorithm, list(candidates or T.grid(algorithm)), folds, validated))
        raise KeyError("noted")

    monkeypatch.setattr(T, "search_nested", note)
    for query in (M._whole_grid, M._fifty_trials):
        with pytest.raises(KeyError, match="noted"):
            query(spark, sf_dir)
    every = [("random_forest", T.grid("random_forest", T.FOREST_GRID), 5, None), ("random_forest", T.draw_trials("random_forest", 50), 5, None)]
    assert asked == every and [len(a[1]) for a in asked] == [81, 50]
    assert max(c["n_estimators"] for c in asked[0][1] + asked[1][1]) == 300
