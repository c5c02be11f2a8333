"""Regression metrics as aggregate expressions over actual and predicted."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gablework.functions.columns import ratio


def residual(actual: str, predicted: str) -> Column:
    return F.col(actual) - F.col(predicted)


def percent_error(actual: str, predicted: str) -> Column:
    """Absolute error relative to the actual value, in percent."""
    return F.abs(ratio(residual(actual, predicted), F.col(actual))) * 100.0


def mse(actual: str, predicted: str) -> Column:
    r = residual(actual, predicted)
    return F.avg(r * r)


def rmse(actual: str, predicted: str) -> Column:
    return F.sqrt(mse(actual, predicted))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(residual(actual, predicted)))


def r2(actual: str, predicted: str) -> Column:
    """1 - SSE / (n * population variance); NULL for n < 2 or no variance."""
    r = residual(actual, predicted)
    total = F.var_pop(actual) * F.count(actual)
    return F.when(F.count(actual) >= 2, 1.0 - ratio(F.sum(r * r), total))


def mape(actual: str, predicted: str) -> Column:
    return F.avg(percent_error(actual, predicted))


def explained_variance(actual: str, predicted: str) -> Column:
    return 1.0 - ratio(F.var_pop(residual(actual, predicted)), F.var_pop(actual))


def core_metrics(actual: str = "price", predicted: str = "predicted") -> dict[str, Column]:
    return {
        "mse": mse(actual, predicted),
        "rmse": rmse(actual, predicted),
        "mae": mae(actual, predicted),
        "r2": r2(actual, predicted),
        "mape": mape(actual, predicted),
    }


def named(metrics: dict[str, Column], *names: str) -> list[Column]:
    return [metrics[n].alias(n) for n in (names or metrics)]
