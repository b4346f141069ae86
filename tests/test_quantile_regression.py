"""Fitted forecast quantiles: coverage on later rows, the least loss, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.plans.quantile_regression import coverage, fit_quantiles


def loss(y, line, q):
    return np.maximum(q * (y - line), (q - 1) * (y - line)).mean()


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x, z = rng.normal(3, 2, 6000), rng.normal(size=6000)
    y = 50 + 3 * x - z + (1 + 0.5 * np.abs(x)) * rng.standard_t(4, 6000)
    return x, z, y, spark.createDataFrame([(float(a), float(b), 7.0, float(c), i) for i, (a, b, c) in enumerate(zip(x, z, y, strict=True))], "x double, z double, same double, y double, i int")


def test_later_rows_are_covered_and_the_loss_is_least(table):
    x, z, y, rows = table
    model = fit_quantiles(rows.where("i < 4000"), ["x", "z", "same"], "y")
    got = coverage(model.predict(rows.where("i >= 4000")), "y").first()
    assert got["n"] == 2000 and got["crossings"] == 0
    assert got["inside"] == pytest.approx(0.8, abs=0.03)
    for q in (10, 50, 90):
        assert got[f"below_y_hat_p{q}"] == pytest.approx(q / 100, abs=0.03)
    # No line near the fitted one is better on the rows it was fitted on.
    inputs = np.c_[np.ones(4000), (x[:4000] - model.means[0]) / model.scales[0], (z[:4000] - model.means[1]) / model.scales[1]]
    rng = np.random.default_rng(2)
    for q, weights in zip(model.quantiles, model.weights, strict=True):
        assert weights[3] == pytest.approx(0, abs=1e-6)
        best = loss(y[:4000], inputs @ np.array(weights[:3]), q)
        for _ in range(200):
            assert loss(y[:4000], inputs @ (np.array(weights[:3]) + rng.normal(0, 0.1, 3)), q) > best - 2e-4
        assert (y[:4000] <= inputs @ np.array(weights[:3])).mean() == pytest.approx(q, abs=0.01)


def test_without_features_it_is_the_quantile(spark):
    values = [float(v) for v in range(1, 1002)]
    model = fit_quantiles(spark.createDataFrame([(v,) for v in values], "y double"), [], "y", (0.25, 0.75))
    got = model.predict(spark.range(1)).first()
    assert got["y_hat_p25"] == pytest.approx(251, abs=3) and got["y_hat_p75"] == pytest.approx(751, abs=3)


def test_odd_rows(spark):
    rows = [(float(i), 2.0 * i + i % 3) for i in range(60)] + [(None, 1.0), (1.0, None), (math.nan, 1.0), (2.0, math.nan)]
    table = spark.createDataFrame(rows, "x double, y double").withColumns({"x0": F.lit(9), "_ordered": F.lit(3)})
    model = fit_quantiles(table, ["x"], "y", (0.9, 0.1))
    got = model.predict(table)
    assert model.quantiles == (0.1, 0.9)
    assert got.where("x IS NULL OR isnan(x)").where("y_hat_p10 IS NOT NULL OR y_hat_p90 IS NOT NULL").isEmpty()
    assert got.where("x IS NOT NULL AND NOT isnan(x)").where("y_hat_p10 > y_hat_p90").isEmpty()
    same = fit_quantiles(spark.createDataFrame([(1.0, 5.0)] * 4, "x double, y double"), ["x"], "y")
    assert same.predict(spark.createDataFrame([(1.0,)], "x double")).first()["y_hat_p50"] == pytest.approx(5)
    with pytest.raises(ValueError):
        fit_quantiles(table.where("false"), ["x"], "y")
