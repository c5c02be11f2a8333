"""Sketched drift, the stateful abort, late prices, contiguous folds, versioned files."""

import time

import pytest
from pyspark.sql import functions as F

from gablework.operators import drift as D
from gablework.operators import splits as L
from gablework.plans.listings import to_serving_log
from gablework.session import stage
from gablework.sources.manifest import Store
from gablework.streaming import abort, drift, performance, telemetry


def test_sketched_statistic_is_within_its_bound(spark):
    rows = spark.range(40_000).select(
        (F.rand(1) * 10).alias("a"), F.randn(2).alias("b"), (F.rand(3) * 5).cast("int").alias("c"), F.lit(None).cast("double").alias("d"),
        (F.col("id") % 3 == 0).alias(D.CURRENT),
    )
    moved = stage(rows.withColumn("b", F.when(F.col(D.CURRENT), F.col("b") * 1.2).otherwise(F.col("b"))))
    names = ["a", "b", "c", "d"]
    exact = {r["column"]: r for r in D.ks_drift(moved, names).collect()}
    reference, current = (D.sketches(moved.where(F.col(D.CURRENT) == flag), names) for flag in (False, True))
    got = {r["column"]: r for r in D.ks_from_sketches(reference, current).collect()}
    for name in "abc":
        assert abs(got[name]["ks_statistic"] - exact[name]["ks_statistic"]) <= got[name]["error_bound"] < 0.005
        assert got[name]["reference_rows"] == exact[name]["reference_rows"]
    assert got["b"]["drift_detected"] and not got["a"]["drift_detected"]
    assert got["d"]["ks_statistic"] is None and not got["d"]["drift_possible"]


def test_monitor_reads_its_reference_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    reference = spark.range(1000).select((F.col("id") * 1.0).alias("x")).mapInPandas(count, "x double")
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.range(300).select((F.col("id") * 10.0 / 3).alias("x")).repartition(3).write.parquet(folder)

    def run():
        incoming = telemetry.read_stream(spark, folder, maxFilesPerTrigger=1)
        drift.start_sketch_monitor(reference, incoming, ["x"], out, state, None).awaitTermination()
        return spark.read.parquet(f"{out}/tests").orderBy("batch").collect()

    rows = run()
    assert seen.value == 1000 and len(rows) == 3 and rows[0]["current_rows"] < rows[1]["current_rows"] < rows[2]["current_rows"] == 300
    assert rows[-1]["ks_statistic"] <= 0.02
    # After a restart the sketches go on from where they were, and the reference is not read again.
    spark.range(700).select(F.lit(5000.0).alias("x")).coalesce(1).write.mode("append").parquet(folder)
    rows = run()
    assert seen.value == 1000 and rows[-1]["current_rows"] == 1000 and rows[-1]["ks_statistic"] == pytest.approx(0.7, abs=0.01)
    assert rows[-1]["drift_detected"] and not rows[0]["drift_detected"]


REQUESTS = "event_id long, ts timestamp, user_id long, variant string, arm string, response_time double, is_error int"


def test_abort_comes_once_and_is_final(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def put(rows):
        frame = spark.createDataFrame([(i, t, 1, v, "A", 0.1, e) for i, (t, v, e) in enumerate(rows)], "event_id long, ts string, user_id long, variant string, arm string, response_time double, is_error int")
        frame.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        abort.run_aborts(telemetry.read_stream(spark, folder), out, state)
        return [(r["variant"], str(r["abort_at"]), r["requests"]) for r in spark.read.schema(abort.ABORT_DDL).parquet(out).collect()]

    day = "2024-01-01 "
    put([(day + "00:00:05", "canary", 0), (day + "00:00:10", "stable", 1), (day + "00:10:00", "canary", 0)])
    assert run() == []
    # Two bad windows, the later one first; nothing is final before the watermark has passed.
    put([(day + "00:20:40", "canary", 1), (day + "00:20:02", "canary", 1), (day + "00:20:03", "canary", 0)])
    assert run() == []
    put([(day + "03:00:00", "stable", 0)])
    first = [("canary", "2024-01-01 00:20:00", 2)]
    assert run() == first
    # The variant is done: later bad windows change nothing, after a restart neither.
    put([(day + "04:00:00", "canary", 1), (day + "09:00:00", "stable", 0)])
    assert run() == first
    put([(day + "10:00:00", "canary", 1), (day + "19:00:00", "stable", 0)])
    assert run() == first


def test_late_prices_are_joined_and_forgotten(spark, tmp_path):
    def table(name, rows, schema):
        frame = spark.createDataFrame(rows, schema)
        when = schema.split()[-2]
        frame.withColumn(when, F.col(when).cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    said = "listing_id string, predicted double, predicted_at string"
    sold = "listing_id string, price double, sold_at string"
    table("said", [("a", 10.0, "2024-01-01"), ("b", 20.0, "2024-01-02"), ("c", 30.0, "2024-01-03")], said)
    table("sold", [("a", 12.0, "2024-01-05"), ("b", 21.0, "2024-02-20")], sold)

    def run(name):
        streams = [telemetry.read_stream(spark, str(tmp_path / n)) for n in ("said", "sold")]
        joined = performance.joined_late(*streams, "listing_id")
        query = joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        done = query.trigger(availableNow=True).start()
        done.awaitTermination()
        state = done.lastProgress["stateOperators"][0]["numRowsTotal"] if done.lastProgress else None
        return sorted((r["listing_id"], r["price"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()), state

    assert run("first")[0] == [("a", 12.0)]  # b was sold too late
    # c's price comes in a later run and is still in time by event time.
    table("sold", [("c", 31.0, "2024-01-09")], sold)
    assert run("second")[0] == [("a", 12.0), ("c", 31.0)]
    table("said", [("z", 1.0, "2025-01-01")], said)
    table("sold", [("z", 1.0, "2025-01-02")], sold)
    rows, state = run("third")
    assert rows == [("a", 12.0), ("c", 31.0), ("z", 1.0)]
    assert state <= 2  # what the watermark has passed is gone


def test_contiguous_folds_keep_the_order(spark, tmp_path):
    path = str(tmp_path / "rows")
    for i in range(4):
        spark.range(i * 100, i * 100 + 7 + i).coalesce(1).write.mode("append").parquet(path)
    scan = spark.read.parquet(path)
    numbered, n = L.with_positions(scan)
    rows = sorted((r["position"], r["id"]) for r in numbered.collect())
    assert n == len(rows) == 34 and [p for p, _ in rows] == list(range(34))
    assert all(b == a + 1 or a % 100 >= 6 for (_, a), (_, b) in zip(rows, rows[1:]))
    folds = {r["id"]: r["fold"] for r in L.with_contiguous_fold(scan, 5).collect()}
    in_order = [folds[i] for _, i in rows]
    assert in_order == sorted(in_order) and [in_order.count(f) for f in range(5)] == [7, 7, 7, 7, 6]
    with pytest.raises(ValueError):
        L.with_contiguous_fold(scan, 35)
    with pytest.raises(ValueError):
        L.with_contiguous_fold(scan, 1)


def test_versions_and_pruning(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        store.read()
    assert store.prune() == []
    one = store.append(spark.range(10), now=0.0)
    two = store.append(spark.range(10, 15), now=86400.0)
    lost = store.write_set(spark.range(1000))  # the writer dies before it commits
    assert store.numbers() == [1, 2] and store.read().count() == 15 and store.read(1).count() == 10
    three = store.replace(spark.range(3), now=10 * 86400.0)
    # Versions 2 and 3 stay, so every set that either names stays; only the lost one goes, once it is old enough.
    assert store.prune(versions=2, now=11 * 86400.0) == []
    assert store.prune(versions=2, now=time.time() + 2 * 86400) == [lost]
    assert store.numbers() == [2, 3] and store.read(2).count() == 15 and store.read().count() == 3
    # By age the newest alone stays, and the sets of the others go.
    assert store.prune(versions=10, days=5, now=time.time() + 2 * 86400) == sorted({*one.sets, *two.sets} - set(three.sets))
    assert store.numbers() == [3] and store.read().count() == 3


def test_writers_that_meet_both_commit(spark, tmp_path):
    store, other = (Store(spark, str(tmp_path / "store")) for _ in range(2))
    store.append(spark.range(1))
    taken = store.numbers()
    calls = []

    class Slow(Store):
        def numbers(self):
            found = super().numbers()
            if not calls:  # another writer commits between this one's look and its claim
                calls.append(other.append(spark.range(2)))
            return found

    late = Slow(spark, str(tmp_path / "store")).append(spark.range(4))
    assert taken == [1] and calls[0].number == 2 and late.number == 3
    assert store.read().count() == 1 + 2 + 4


def test_late_prices_arrive_in_parts(spark, sf_dir, monkeypatch):
    """Parts in order of time give the rows of one arrival, and no part holds the table."""
    from gablework.plans import model_queries as queries

    runs, once = [], queries.stream.run_once
    monkeypatch.setattr(queries.stream, "run_once", lambda out, path, state, *more: (runs.append(path), once(out, path, state, *more)))
    wanted = sorted(queries._late_prices(spark, sf_dir).collect())
    assert len(runs) == 1
    got = sorted(queries._late_prices(spark, sf_dir, 4000).collect())
    assert len(runs) == 3 and len(got) == len(wanted) > 0
    for a, b in zip(got, wanted):
        assert (a.window_start, a.n) == (b.window_start, b.n) and (a.r2, a.rmse) == pytest.approx((b.r2, b.rmse))


def test_arrivals_are_parted_by_time(spark):
    from gablework.plans import model_queries as queries

    rows = spark.sql("SELECT id, timestamp_seconds(id * 3600) AS at FROM range(0, 100) UNION ALL SELECT 100, NULL")
    parts = queries._arrivals(rows, "at", [1, 3], "parts")
    assert [sorted(r["id"] for r in p.collect()) for p in parts] == [[*range(24), 100], [*range(24, 72)], [*range(72, 100)]]


def test_late_prices_keep_little(spark, sf_dir, tmp_path, monkeypatch):
    """Rows are written once beside what is arriving; what was read goes, and old state is not asked for."""
    from gablework.plans import model_queries as queries

    kept, asked, once = [], [], queries.stream.run_once

    def run(out, path, state, *more):
        asked.append({key: spark.conf.get(key) for key in queries.FEW_STATES})
        once(out, path, state, *more)
        kept.append({p.name.split("-")[0]: sum(spark.read.parquet(str(f)).count() for f in p.rglob("*.parquet")) for p in tmp_path.iterdir() if p.name.startswith("p")})

    monkeypatch.setattr(queries.stream, "run_once", run)
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: str(tmp_path / label))
    before = {key: spark.conf.get(key) for key in queries.FEW_STATES}
    rows = queries.listings(spark, sf_dir).count()
    queries._late_prices(spark, sf_dir, 1500)
    assert len(kept) == -(-rows // 1500) >= 4
    # The last part or two of a side may still lie there, not all that came.
    assert all(n < 0.6 * rows for n in kept[-1].values()) and set(kept[-1]) == {"predictions", "prices"}
    assert asked == [queries.FEW_STATES] * len(kept)
    assert before == {key: spark.conf.get(key) for key in queries.FEW_STATES}
    assert not (tmp_path / "said").exists() and not (tmp_path / "paid").exists()
