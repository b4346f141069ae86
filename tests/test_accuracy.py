import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlake.functions import accuracy
from loadlake.plans import evaluation, monitoring


def measure(spark, rows, expr):
    df = spark.createDataFrame(rows, "y DOUBLE, p DOUBLE")
    return df.agg(expr(F.col("y"), F.col("p")).alias("m")).first().m


def test_mape_basic(spark):
    got = measure(spark, [(100.0, 110.0), (200.0, 190.0), (300.0, 330.0)], accuracy.mape)
    assert 8 < got < 9
    assert got == pytest.approx(100 * (0.1 + 0.05 + 0.1) / 3)


def test_mape_leaves_out_zero_actuals(spark):
    got = measure(spark, [(0.0, 10.0), (100.0, 110.0), (0.0, 20.0), (200.0, 180.0)], accuracy.mape)
    assert 9 < got < 11
    assert got == pytest.approx(10)


def test_mape_of_zeros_only_is_null(spark):
    assert measure(spark, [(0.0, 1.0)], accuracy.mape) is None


def test_null_sides_are_skipped_and_counted(spark):
    df = spark.createDataFrame([("s", 100.0, 90.0), ("s", None, 5.0), ("s", 50.0, None)], "s STRING, load_mw DOUBLE, y_hat_mw DOUBLE")
    row = monitoring.forecast_metrics(df, ["s"]).first()
    assert (row.mae, row.n, row.n_null) == (10, 3, 2)


def test_rmse_mae_smape_pinball(spark):
    rows = [(10.0, 12.0), (20.0, 14.0)]
    assert measure(spark, rows, accuracy.mae) == 4
    assert measure(spark, rows, accuracy.rmse) == pytest.approx(math.sqrt((4 + 36) / 2))
    assert measure(spark, rows, accuracy.smape) == pytest.approx(100 * (2 * 2 / 22 + 2 * 6 / 34) / 2)
    assert measure(spark, rows, lambda y, p: accuracy.pinball(y, p, 0.9)) == pytest.approx((0.1 * 2 + 0.9 * 6) / 2)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(1, 500), st.integers(0, 500)), min_size=1, max_size=20), seed=st.randoms())
def test_mape_does_not_depend_on_row_order(spark, rows, seed):
    rows = [(float(y), float(p)) for y, p in rows]
    shuffled = rows[:]
    seed.shuffle(shuffled)
    assert measure(spark, rows, accuracy.mape) == pytest.approx(measure(spark, shuffled, accuracy.mape))


def test_forecast_is_judged_by_the_hour_it_predicts(spark):
    forecasts = spark.sql(
        "SELECT timestamp'2024-01-01 05:00' AS event_ts_utc, 's' AS series_id, 7.0D AS y_hat_mw, 24 AS horizon_hours"
    )
    measured = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-01-01 05:00', 's', 1.0D), (timestamp'2024-01-02 05:00', 's', 8.0D)"
        " AS t(event_ts_utc, series_id, load_mw)"
    )
    assert monitoring.forecast_vs_actual(forecasts, measured).first().load_mw == 8
    assert monitoring.forecast_vs_actual(forecasts, measured, "reference").first().load_mw == 1


def test_rolling_origin_uses_only_days_before_the_origin(spark, sf_dir):
    from loadlake.catalog.frames import Frames

    f = Frames(spark, sf_dir)
    rows = evaluation.rolling_origin(f.demand, F.lit(f.first_day), F.lit(f.last_day), 1, 3)
    assert rows.where(F.col("last_known_ts") >= F.to_timestamp("origin")).isEmpty()
    assert not rows.isEmpty()


def test_residual_intervals_use_only_residuals_before_the_origin(spark):
    rows = [(d, float(d)) for d in range(10)]
    pairs = spark.createDataFrame(rows, "d INT, residual DOUBLE").select(
        F.lit("s").alias("series_id"),
        F.expr("timestamp'2024-01-01 06:00' + make_dt_interval(d)").alias("target_ts_utc"),
        F.expr("date_add(date'2024-01-01', d)").alias("target_date"),
        F.col("residual").alias("load_mw"),
        F.lit(0.0).alias("y_hat_mw"),
    )
    got = {r.target_date.day: r for r in evaluation.residual_intervals(pairs, days=28).collect()}
    assert sorted(got) == list(range(3, 11))
    # On day 10 (residual 9) the residuals of days 1..8 (0..7) are known.
    assert got[10].n_residuals == 8
    assert got[10].y_hat_p50 == pytest.approx(3.5)
