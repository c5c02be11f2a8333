"""Growing logs, profiles by states, and a change of model under running scoring."""

import json

import pytest
from pyspark.sql import functions as F

from gablework.operators import increments as I
from gablework.operators import profile as A
from gablework.session import stage
from gablework.sources.manifest import Store
from gablework.sources.tail import tail_json_lines, tail_lines
from gablework.streaming import scoring, telemetry


def test_lines_come_once_as_files_grow(spark, tmp_path):
    folder, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def run():
        # Small ranges and blocks, so that lines lie across their borders.
        lines = tail_lines(spark, str(folder), "*.log*", head=16, longest=23, block=7)
        telemetry.run_once(lines, out, state)
        return sorted(r["line"] for r in spark.read.parquet(out).collect())

    first = [f"first line number {i} of a" for i in range(9)] + ["", "äöü"]
    (folder / "a.log").write_text("\n".join(first) + "\nhalf a li")
    (folder / "other.txt").write_text("not a log\n")
    assert run() == sorted(first)
    # The half line is whole now; a file without any line end, and an empty one, give nothing.
    with (folder / "a.log").open("a") as f:
        f.write("ne\nmore\n")
    (folder / "b.log").write_text("no end yet")
    (folder / "c.log").write_text("")
    seen = sorted([*first, "half a line", "more"])
    assert run() == seen
    assert run() == seen
    # Moved to another name with a new line, and a new file under the old name.
    with (folder / "a.log").open("a") as f:
        f.write("last of the old\n")
    (folder / "a.log").rename(folder / "a.log.1")
    (folder / "a.log").write_text("of the new file, long enough to be known\n")
    assert run() == sorted([*seen, "last of the old", "of the new file, long enough to be known"])


def test_json_tail_passes_blank_lines(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    line = json.dumps({"timestamp": "2025-07-13T12:25:20.836", "level": "INFO", "response_time": 0.5})
    (folder / "a.log").write_text(f"{line}\n\nbroken\n")
    out = str(tmp_path / "out")
    telemetry.run_once(tail_json_lines(spark, str(folder)), out, str(tmp_path / "state"))
    rows = sorted(spark.read.parquet(out).collect(), key=lambda r: r["level"] or "")
    assert [r["level"] for r in rows] == [None, "INFO"] and rows[1]["ts"].microsecond == 836000


def test_profile_by_states_equals_one_over_all_rows(spark, tmp_path):
    rows = stage(
        spark.range(20_000).select(
            (F.randn(1) * 3 + 1e6).alias("a"), (F.rand(2) * 50).cast("int").alias("b"), F.lit(None).cast("double").alias("c"),
            (F.col("id") % 4).alias("part"),
        )
    )
    names, folders = ["a", "b", "c"], [str(tmp_path / f"part{i}") for i in range(4)]
    for i, folder in enumerate(folders):
        rows.where(f"part = {i}").drop("part").write.parquet(folder)
    read = []

    def count(folder):
        read.append(folder)
        return spark.read.parquet(folder)

    store = Store(spark, str(tmp_path / "store"))
    assert I.add_folders(store, folders[:1], names, count) == folders[:1]
    assert I.add_folders(store, folders, names, count) == folders[1:]
    assert I.add_folders(store, folders, names, count) == []
    assert read == folders
    got = {r["column"]: r for r in I.merged_profile(store.read()).collect()}
    for r in A.describe(rows, names).collect():
        mine = got[r["column"]]
        for name in ("count", "mean", "std", "min", "max"):
            assert mine[name] == (None if r[name] is None else pytest.approx(r[name], rel=1e-12, abs=1e-9)), name
    for name in "ab":
        for q, p in I.QUARTILES.items():
            below, upto = rows.agg(F.avg((F.col(name) < got[name][q]).cast("int")), F.avg((F.col(name) <= got[name][q]).cast("int"))).first()
            assert below - I.rank_error() <= p <= upto + I.rank_error()
    assert got["b"]["distinct"] == 50 and abs(got["a"]["distinct"] / 20_000 - 1) < 0.04
    assert got["c"]["count"] == 0 and got["c"]["p50"] is None and got["c"]["distinct"] == 0
    # Two writers that added the same folder count it once.
    store.append(store.read().where(F.col("folder") == folders[0]))
    again = {r["column"]: r["count"] for r in I.merged_profile(store.read()).collect()}
    assert again == {"a": 20_000, "b": 20_000, "c": 0}


def test_model_changes_between_batches_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "models"))
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.range(30).repartition(3).write.parquet(folder)
    scoring.promote(store, "v1", "one")
    calls, loads = [], []

    def load(location):
        loads.append(location)

        def score(batch):
            calls.append(location)
            if len(calls) == 2:
                # Promoted in the middle of a batch, which then fails.
                scoring.promote(store, "v2", "two")
                raise RuntimeError("lost")
            return batch.withColumn("by", F.lit(location))

        return score

    def run():
        scoring.run_promoted_scoring(telemetry.read_stream(spark, folder, maxFilesPerTrigger=1), store, load, out, state)

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    rows = spark.read.parquet(f"{out}/scored").collect()
    assert sorted(r["id"] for r in rows) == list(range(30))
    versions = {}
    for r in rows:
        versions.setdefault(r["batch_id"], set()).add((r["model_version"], r["by"]))
    # The batch that failed keeps the version it began with.
    assert versions == {0: {("v1", "one")}, 1: {("v1", "one")}, 2: {("v2", "two")}}
    assert loads == ["one", "one", "two"]
