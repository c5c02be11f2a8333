"""Canary abort as a stateful stream: once, at the first bad window, for good."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from gablework.operators.telemetry import rates
from gablework.roles import CANARY_ERROR
from gablework.streaming.telemetry import run_once, with_event_time

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ABORT_DDL = "variant string, abort_at timestamp, requests bigint, error_rate double"


def closed_windows(requests: DataFrame, every: str = "30 seconds", by: str = "variant") -> DataFrame:
    """Rates of closed windows with ``closes_at``, an event time that further stateful steps may use."""
    grouped = with_event_time(requests).groupBy(F.window("ts", every).alias("w"), by).agg(*rates())
    return grouped.select(
        by, F.col("w.start").alias("window_start"), F.window_time("w").alias("closes_at"), "requests", "errors", "error_rate"
    )


def _processor(limit: float, variant: str) -> Any:
    """The state machine of one variant, shipped to the workers by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Abort(StatefulProcessor):
        """Watches until a bad window is final, reports it, and then ignores whatever comes."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("abort", "abort_at timestamp, requests bigint, error_rate double, done boolean")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            known = self.state.get() if self.state.exists() else None
            if key[0] == variant and (known is None or not known[3]):
                for part in rows:
                    bad = part[part["error_rate"] > limit].sort_values("window_start")
                    if not len(bad):
                        continue
                    first = bad.iloc[0]
                    if known is None or first["window_start"] < pd.Timestamp(known[0]):
                        known = (first["window_start"].to_pydatetime(), int(first["requests"]), float(first["error_rate"]), False)
                        self.state.update(known)
                        # All windows that end by then have come when the watermark gets there.
                        self.handle.registerTimer(int(first["closes_at"].timestamp() * 1000))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            known = self.state.get()
            if known[3]:
                return
            self.state.update((*known[:3], True))
            yield pd.DataFrame({"variant": [key[0]], "abort_at": [known[0]], "requests": [known[1]], "error_rate": [known[2]]})

        def close(self) -> None:
            pass

    return Abort()


@contextlib.contextmanager
def _state_in_files(spark: SparkSession) -> Iterator[None]:
    """The state store that typed state needs, for queries started within."""
    before = spark.conf.get(PROVIDER_KEY)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER_KEY, before)


def stream_aborts(requests: DataFrame, every: str = "30 seconds", limit: float = CANARY_ERROR, variant: str = "canary") -> DataFrame:
    """At most one row, ever: the variant's first closed window whose error rate exceeds the limit.

    Requests are added up per window first, in parallel and by Spark's own
    aggregation; only closed windows reach the state of a variant, which is one
    row.  A timer at the window's end reports it, and the variant is then done.
    """
    # Other variants are passed over within: a filter here would be moved below the
    # watermark, which all requests should carry forward.
    windows = closed_windows(requests, every)
    return windows.groupBy("variant").transformWithStateInPandas(
        statefulProcessor=_processor(limit, variant), outputStructType=ABORT_DDL, outputMode="Append", timeMode="EventTime"
    )


def run_aborts(requests: DataFrame, path: str, checkpoint: str, **settings) -> None:
    """Work off what is there, append aborts to ``path``, and stop; a later run goes on from the checkpoint."""
    with _state_in_files(requests.sparkSession):
        run_once(stream_aborts(requests, **settings), path, checkpoint)
