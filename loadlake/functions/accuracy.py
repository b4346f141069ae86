"""Forecast accuracy as aggregate expressions; rows with a NULL side are skipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mape(y: Column, y_hat: Column) -> Column:
    """Mean absolute percentage error; zero actuals do not count."""
    return F.avg(F.abs((y - y_hat) / F.nullif(y, F.lit(0.0)))) * 100


def smape(y: Column, y_hat: Column) -> Column:
    """Symmetric percentage error in 0..200; rows where both sides are 0 do not count."""
    return F.avg(2 * F.abs(y - y_hat) / F.nullif(F.abs(y) + F.abs(y_hat), F.lit(0.0))) * 100


def mae(y: Column, y_hat: Column) -> Column:
    return F.avg(F.abs(y - y_hat))


def rmse(y: Column, y_hat: Column) -> Column:
    return F.sqrt(F.avg((y - y_hat) * (y - y_hat)))


def pinball(y: Column, y_hat: Column, quantile: float) -> Column:
    """Pinball loss of ``y_hat`` taken as the ``quantile`` forecast."""
    error = y - y_hat
    return F.avg(F.greatest(quantile * error, (quantile - 1) * error))


def unscored(y: Column, y_hat: Column) -> Column:
    """Joined rows that no measure could use."""
    return F.count_if(y.isNull() | y_hat.isNull())
