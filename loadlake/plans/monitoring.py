"""Actuals, forecast metrics, drift and the views on them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions import accuracy
from loadlake.operators.grid import fill_grid
from loadlake.operators.psi import DRIFT_THRESHOLD, psi
from loadlake.plans.gold import with_series_id

DRIFT_FEATURES = ("load_mw", "temperature_2m")
RECENT_DAYS = 7
DRIFT_HISTORY_DAYS = 35


def actuals(gold: DataFrame, created_at: Column, start: date | None = None, end: date | None = None) -> DataFrame:
    """Measured load of the gold rows of a closed day range."""
    rows = with_series_id(gold)
    if start is not None:
        rows = rows.where(F.col("dt") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("dt") <= F.lit(end))
    return rows.select("event_ts_utc", "series_id", "load_mw", "dt", created_at.alias("created_at_utc"))


def forecast_vs_actual(
    forecasts: DataFrame, measured: DataFrame, align: Literal["target", "reference"] = "target"
) -> DataFrame:
    """Forecast rows with the load they are judged by, ``target_ts_utc`` being its hour.

    A forecast row carries the hour of its features. ``target`` compares it
    with the load ``horizon_hours`` later, which is what it predicts;
    ``reference`` with the load of the feature hour.
    """
    hour = F.col("event_ts_utc")
    if align == "target":
        hour = F.timestamp_seconds(F.unix_seconds("event_ts_utc") + F.col("horizon_hours") * 3600)
    keyed = forecasts.drop("target_ts_utc").withColumn("target_ts_utc", hour)
    load = measured.select("series_id", F.col("event_ts_utc").alias("target_ts_utc"), "load_mw")
    return keyed.join(load, ["series_id", "target_ts_utc"])


def accuracy_columns(y: Column, y_hat: Column) -> list[Column]:
    return [
        accuracy.mape(y, y_hat).alias("mape"),
        accuracy.mae(y, y_hat).alias("mae"),
        accuracy.rmse(y, y_hat).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
        accuracy.unscored(y, y_hat).alias("n_null"),
    ]


def forecast_metrics(pairs: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """MAPE, MAE and RMSE per target day and series, and per model where the pairs name one.

    Forecasts of a shadow model thus never change the figures of another.
    """
    if keys is None:
        keys = [k for k in ("target_date", "series_id", "model_name") if k != "model_name" or k in pairs.columns]
    return pairs.groupBy(*keys).agg(*accuracy_columns(F.col("load_mw"), F.col("y_hat_mw")))


def _windows(df: DataFrame, day: str, eval_date: date, recent_days: int, history_days: int) -> DataFrame:
    """Rows of the recent window [D - recent, D] and of the baseline before it, back to D - history."""
    recent_start = eval_date - timedelta(days=recent_days)
    baseline_start = eval_date - timedelta(days=history_days)
    return df.where(F.col(day).between(F.lit(baseline_start), F.lit(eval_date))).withColumn(
        "_recent", F.col(day) >= F.lit(recent_start)
    )


def drift(
    gold: DataFrame,
    eval_date: date,
    features: Sequence[str] = DRIFT_FEATURES,
    recent_days: int = RECENT_DAYS,
    history_days: int = DRIFT_HISTORY_DAYS,
    threshold: float = DRIFT_THRESHOLD,
    by_series: bool = True,
    day: str = "dt",
) -> DataFrame:
    """PSI per (series, feature), or per feature over all series together.

    The recent window is the closed range [D - 7, D], the baseline the days
    before it. Features that are no columns are passed over. One series has
    at most a row per hour of the window; all series together have no bound
    and take the quantiles that need none.
    """
    present = [f for f in features if f in gold.columns]
    keys = ["series_id", "feature"] if by_series else ["feature"]
    ids = [k for k in keys if k != "feature"] + ["_recent"]
    values = (
        _windows(with_series_id(gold), day, eval_date, recent_days, history_days)
        .select(*ids, *[F.col(f).cast("double").alias(f) for f in present])
        .unpivot(ids, present, "feature", "_value")
    )
    return psi(values, keys, "_value", "_recent", pooled=not by_series).select(
        *keys,
        "psi",
        "n_baseline",
        "n_recent",
        F.lit(eval_date).alias("eval_date"),
        (F.col("psi") > threshold).alias("is_drift"),
    )


def residual_drift(
    pairs: DataFrame, eval_date: date, recent_days: int = RECENT_DAYS, history_days: int = DRIFT_HISTORY_DAYS, by_series: bool = True
) -> DataFrame:
    """Drift of ``y - ŷ`` by target date."""
    residuals = pairs.withColumn("residual", F.col("load_mw") - F.col("y_hat_mw"))
    return drift(residuals, eval_date, ["residual"], recent_days, history_days, by_series=by_series, day="target_date")


def daily_volume(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Row count per (keys, day)."""
    return rows.groupBy(*keys, F.to_date(ts).alias("dt")).agg(F.count(F.lit(1)).alias("n_rows"))


def fill_days(volume: DataFrame, keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """``volume`` over all days of [first, last]; a day without rows counts 0. Reads ``volume`` twice."""
    return fill_grid(volume, keys, first, last, "dt", "n_rows", "INTERVAL 1 DAY").na.fill(0, ["n_rows"])


def volume_anomaly(
    volume: DataFrame, keys: Sequence[str], days: int = 7, tolerance: float = 3.0
) -> DataFrame:
    """Days whose row count is more than ``tolerance`` deviations from the ``days`` days before.

    A key has one row per day here, so a window per key stays small.
    """
    before = Window.partitionBy(*keys).orderBy("dt").rowsBetween(-days, -1)
    scored = volume.withColumns(
        {"mean_before": F.avg("n_rows").over(before), "std_before": F.stddev("n_rows").over(before)}
    )
    distance = F.abs(F.col("n_rows") - F.col("mean_before"))
    return scored.withColumn("is_anomaly", F.coalesce(distance > tolerance * F.col("std_before"), F.lit(False)))


def freshness(rows: DataFrame, source: str, ts: str, now: Column, limit_seconds: int) -> DataFrame:
    """Newest timestamp per source, its age and whether it is within the limit."""
    age = F.unix_seconds(now) - F.unix_seconds("last_ts")
    return (
        rows.groupBy(F.col(source).alias("source"))
        .agg(F.max(ts).alias("last_ts"))
        .withColumn("age_seconds", age)
        .withColumn("is_fresh", F.col("age_seconds") <= limit_seconds)
    )


def in_time_range(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows of a closed time range in time order, for a chart."""
    return df.where(F.col(ts).between(start, end)).orderBy(ts)


def mape_over_time(metrics: DataFrame, start: Column, end: Column) -> DataFrame:
    """MAPE per target day as a time series."""
    points = metrics.select(F.to_timestamp("target_date").alias("time"), "series_id", F.col("mape").alias("MAPE_pct"))
    return in_time_range(points, "time", start, end)


def successful_runs(runs: DataFrame, now: Column, days: int = 7, success: str = "success", wanted: int = 7) -> DataFrame:
    """Successful runs of the last ``days`` days and whether they reach ``wanted``."""
    recent = (F.col("created_at") > now - F.make_dt_interval(F.lit(days))) & (F.col("created_at") <= now)
    return (
        runs.where(recent & (F.col("status") == success))
        .agg(F.count(F.lit(1)).alias("n_success"))
        .withColumn("is_green", F.col("n_success") >= wanted)
    )
