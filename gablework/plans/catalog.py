"""All registered queries."""

from __future__ import annotations

from gablework.plans import data_queries, model_queries, report_queries  # noqa: F401  (register on import)
from gablework.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
