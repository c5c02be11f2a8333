"""How a query and its DuckDB twin are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gablework.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()}) if digits else df


def oracle_text(ctes: str, body: str, digits: dict[str, int]) -> str:
    """The twin: ``body`` over the given CTEs, rounded as the Spark result is."""
    parts = [ctes.strip(), f"result AS ({body.strip()})"] if ctes else [f"result AS ({body.strip()})"]
    # Adding zero turns a negative zero left by rounding into a plain one.
    swaps = ", ".join(f"round({c}, {n}) + 0e0 AS {c}" for c, n in digits.items())
    chosen = f"* REPLACE ({swaps})" if swaps else "*"
    return "WITH " + ",\n".join(parts) + f"\nSELECT {chosen} FROM result"


def register(name: str, query: Query, ctes: str | None = None, body: str | None = None, **digits: int) -> None:
    """Add a query; without ``body`` it has no SQL twin."""
    if name in QUERIES:
        raise ValueError(f"registered twice: {name}")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return rounded(query(spark, sf_dir), digits)

    QUERIES[name] = run
    if body is not None:
        ORACLES[name] = oracle_text(ctes or "", body, digits)
