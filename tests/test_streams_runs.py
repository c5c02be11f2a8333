from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gablework.operators import runs as X
from gablework.operators import training as T
from gablework.operators.telemetry import windowed_rates
from gablework.plans.listings import listings, serving_log, to_serving_log
from gablework.session import scratch_path, scratch_root
from gablework.sources import logs, runs
from gablework.streaming import scoring, telemetry


class FakeSession:
    """Just the settings and the master of a session."""

    def __init__(self, master, folder=None):
        settings = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{id(self)}")


def test_scratch_follows_the_session(tmp_path):
    assert scratch_root(FakeSession("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert scratch_path(FakeSession("yarn", "/shared"), "a").startswith("/shared/a-")
    with pytest.raises(RuntimeError):
        scratch_root(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_stream_equals_batch_on_closed_windows(spark, sf_dir, tmp_path):
    source = to_serving_log(telemetry.read_stream(spark, f"{sf_dir}/events.parquet"))
    out = str(tmp_path / "out")
    telemetry.run_once(telemetry.stream_windowed_rates(source, "1 hour"), out, str(tmp_path / "state"))
    streamed = spark.read.parquet(out)
    last = streamed.agg(F.max("window_end")).first()[0]
    batch = windowed_rates(serving_log(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "1 hour")
    assert sorted(streamed.collect()) == sorted(batch.where(F.col("window_end") <= last).collect())
    assert streamed.count() > 10


def test_scoring_stream_splits_good_and_bad(spark, tiny, sf_dir, tmp_path):
    model = T.train(tiny, n_estimators=3)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    tiny.withColumn("bedrooms", F.when(F.col("listing_id") == "a", 0).otherwise(F.col("bedrooms"))).write.parquet(folder)
    scoring.run_scoring(model, telemetry.read_stream(spark, folder), out, str(tmp_path / "state"))
    assert spark.read.parquet(f"{out}/scored").count() == 4
    assert spark.read.parquet(f"{out}/rejected").first()["reasons"] == ["bedrooms"]


def test_log_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        '{"timestamp": "2025-07-13T12:25:20.836", "level": "INFO", "variant": "stable", "response_time": 0.1, "is_error": 0}\n'
    )
    row = logs.read_json_lines(spark, str(tmp_path / "a.log")).first()
    assert row["ts"].microsecond == 836000


@pytest.fixture
def run_folder(tmp_path):
    run = "0123456789abcdef0123456789abcdef"
    base = tmp_path / "400000000000000001" / run
    (base / "metrics").mkdir(parents=True)
    (base / "params").mkdir()
    (base / "metrics" / "test_rmse").write_text("1752419068000 30881.87 0\n1752419068000 30881.87 0\n")
    (base / "metrics" / "test_r2").write_text("1752419068000 0.5 0\n1752419069000 0.96 1\n")
    (base / "params" / "n_estimators").write_text("300")
    (base / "meta.yaml").write_text(
        f"end_time: 1752419066000\nrun_id: {run}\nrun_name: final\nstart_time: 1752419059700\nstatus: 3\nuser_id: x\n"
    )
    return str(tmp_path), run


def test_run_store(spark, run_folder):
    path, run = run_folder
    metrics = runs.read_metrics(spark, path)
    assert metrics.count() == 3
    latest = {r["key"]: r["value"] for r in X.latest(metrics).collect()}
    assert latest == {"test_rmse": 30881.87, "test_r2": 0.96}
    assert runs.read_params(spark, path).first()["value"] == "300"
    row = X.durations(runs.read_run_info(spark, path)).first()
    assert row["run_id"] == run and row["run_name"] == "final"
    assert row["seconds"] == pytest.approx(6.3) and row["usable"]


def test_metrics_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("run one", "r+2", 5, 0.25, 0)], "run_id string, key string, ts_ms bigint, value double, step int")
    path = str(tmp_path / "runs")
    runs.write_metrics(rows, path)
    assert runs.read_metrics(spark, path, runs.PARTITION_LAYOUT).collect() == rows.collect()


def test_listings_are_unique(spark, sf_dir):
    df = listings(spark, sf_dir)
    assert df.count() == 6000 and df.select("listing_id").distinct().count() == 6000
