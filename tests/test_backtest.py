"""Running sums of normal equations against a fit from the raw rows of every origin."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.plans.backtest import fitted_lines, refitted_backtest, samples

START = datetime(2024, 1, 1)


def loads(level: float, seed: int, days: int = 30) -> list[tuple[datetime, float]]:
    rng = np.random.default_rng(seed)
    hours = np.arange(days * 24)
    y = level * (1 + 0.1 * np.sin(hours * 2 * np.pi / 24) + 0.05 * np.sin(hours * 2 * np.pi / 168)) + level * 0.02 * rng.standard_normal(len(hours))
    return [(START + timedelta(hours=int(h)), float(v)) for h, v in zip(hours, y, strict=True) if rng.random() > 0.03]


def brute(rows: list[tuple[datetime, float]], origin: date, h: int, train_days: int | None):
    """The line of one origin by least squares over its raw rows, and its errors on the h-th day."""
    known = dict(rows)
    parts = defaultdict(list)
    for at, y in rows:
        x = (known.get(at - timedelta(days=h)), known.get(at - timedelta(days=7)))
        if None in x:
            continue
        age = (origin - at.date()).days
        if age >= 1 and (train_days is None or age <= train_days):
            parts["train"].append((1.0, *x, y))
        if age == 1 - h:
            parts["test"].append((1.0, *x, y))
    train, test = (np.array(parts[name]) for name in ("train", "test"))
    if not len(train) or not len(test):
        return None
    w = np.linalg.lstsq(train[:, :-1] / train[:, :-1].max(axis=0), train[:, -1], rcond=None)[0] / train[:, :-1].max(axis=0)
    return len(train), w, np.abs(test[:, -1] - test[:, :-1] @ w).mean(), len(test)


@pytest.mark.parametrize("train_days", [None, 10])
def test_lines_equal_a_refit_from_raw_rows(spark, train_days):
    table = {"small": loads(50.0, 1), "huge": loads(1e9, 2)}
    demand = spark.createDataFrame([(s, at, y, 1) for s, rows in table.items() for at, y in rows], "series_id string, event_ts_utc timestamp, load_mw double, n int")
    got = refitted_backtest(demand, date(2024, 1, 12), date(2024, 1, 30), 3, 3, train_days).collect()
    seen = set()
    for r in got:
        n_train, w, mae, n = brute(table[r.series_id], r.origin, r.horizon_day, train_days)
        assert (r.n_train, r.n) == (n_train, n)
        assert [r.recent, r.week] == pytest.approx(list(w[1:]), rel=1e-6, abs=1e-6)
        assert r.intercept == pytest.approx(w[0], rel=1e-6) and r.mae == pytest.approx(mae, rel=1e-6)
        seen.add((r.series_id, r.origin.day, r.horizon_day))
    want = {
        (s, day, h) for s in table for day in range(12, 31, 3) for h in (1, 2, 3)
        if brute(table[s], date(2024, 1, day), h, train_days) is not None
    }
    assert seen == want and len(seen) > 30


def test_later_loads_change_no_line(spark):
    rows = loads(50.0, 3)
    demand = spark.createDataFrame([("s", at, y) for at, y in rows], "series_id string, event_ts_utc timestamp, load_mw double")
    changed = demand.withColumn("load_mw", F.when(F.col("event_ts_utc") >= "2024-01-20", F.col("load_mw") * 100).otherwise(F.col("load_mw")))
    lines = []
    for table in (demand, changed):
        fitted = fitted_lines(samples(table, 2), ["recent", "week"], date(2024, 1, 20), date(2024, 1, 20))
        lines.append({r.horizon_day: (r.n_train, r.weights) for r in fitted.collect()})
    assert lines[0].keys() == lines[1].keys() == {1, 2}
    for h, (n, weights) in lines[0].items():
        assert lines[1][h][0] == n and lines[1][h][1] == pytest.approx(weights, rel=1e-9)


def test_odd_rows(spark):
    """No rows, NULLs, repeated hours, loads that never change, too few rows, a horizon that is too long."""
    schema = "series_id string, event_ts_utc timestamp, load_mw double, y string, week string"
    hours = [START + timedelta(hours=h) for h in range(24 * 20)]
    rows = [("flat", at, 7.0, "a", "b") for at in hours] + [("flat", hours[50], 3.0, "a", "b"), ("flat", hours[51], None, "a", "b")]
    rows += [("short", at, 1.0, None, None) for at in hours[:48]] + [("none", at, None, None, None) for at in hours] + [("flat", None, 1.0, None, None)]
    rows += [("nan", at, float("nan"), None, None) for at in hours]
    demand = spark.createDataFrame(rows, schema)
    got = refitted_backtest(demand, date(2024, 1, 10), date(2024, 1, 20), 5, 1, min_rows=10).collect()
    assert sorted((r.series_id, r.origin.day, r.n) for r in got) == [("flat", 10, 24), ("flat", 15, 24), ("flat", 20, 24)]
    assert all(r.mae == pytest.approx(0, abs=1e-9) for r in got)
    assert refitted_backtest(demand.where("false"), date(2024, 1, 10), date(2024, 1, 20)).count() == 0
    with pytest.raises(ValueError, match="horizon"):
        refitted_backtest(demand, date(2024, 1, 10), date(2024, 1, 20), horizon_days=8)
