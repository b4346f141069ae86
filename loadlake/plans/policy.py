"""Decisions on monitoring results: retrain, alert, fall back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.operators.asof import asof_join
from loadlake.operators.psi import DRIFT_THRESHOLD

MAPE_THRESHOLD = 6.0
LOOKBACK_DAYS = 7


def retrain_decision(
    metrics: DataFrame | None,
    drift: DataFrame | None,
    as_of: date,
    lookback_days: int = LOOKBACK_DAYS,
    mape_threshold: float = MAPE_THRESHOLD,
    psi_threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """One row: the worst MAPE, whether any feature drifted, and whether to retrain.

    A missing table or one without rows in the lookback is no evidence.
    """
    spark = (metrics if metrics is not None else drift).sparkSession
    start = F.lit(as_of - timedelta(days=lookback_days))
    end = F.lit(as_of)
    evidence = spark.createDataFrame([], "max_mape DOUBLE, drifted BOOLEAN")
    if metrics is not None:
        worst = metrics.where(F.col("target_date").between(start, end)).agg(F.max("mape").alias("max_mape"))
        evidence = evidence.unionByName(worst, allowMissingColumns=True)
    if drift is not None:
        flagged = F.bool_or(F.col("is_drift") | (F.col("psi") > psi_threshold))
        found = drift.where(F.col("eval_date").between(start, end)).agg(flagged.alias("drifted"))
        evidence = evidence.unionByName(found, allowMissingColumns=True)
    bad_metrics = F.coalesce(F.col("max_mape") > mape_threshold, F.lit(False))
    bad_drift = F.coalesce(F.col("drifted"), F.lit(False))
    return (
        evidence.agg(F.max("max_mape").alias("max_mape"), F.bool_or("drifted").alias("drifted"))
        .select("max_mape", bad_metrics.alias("metrics_bad"), bad_drift.alias("drift_bad"))
        .withColumn("retrain", F.col("metrics_bad") | F.col("drift_bad"))
    )


def readings(df: DataFrame, name: str | Column, subject: Column, day: Column, value: Column, threshold: float) -> DataFrame:
    """One monitored measure in the common form of ``alert_rows``."""
    return df.select(
        (F.lit(name) if isinstance(name, str) else name).alias("measure"),
        subject.alias("subject"),
        day.alias("day"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
    )


def alert_rows(measures: Sequence[DataFrame]) -> DataFrame:
    """Readings beyond their threshold."""
    first, *rest = measures
    for other in rest:
        first = first.unionByName(other)
    return first.where(F.col("value") > F.col("threshold"))


def last_known_good(wanted: DataFrame, forecasts: DataFrame, max_age_seconds: int | None = None) -> DataFrame:
    """Every wanted (series, target hour) with its forecast, or the newest earlier one.

    ``is_fallback`` tells which. Used when a scoring run failed.
    """
    good = forecasts.where(F.col("y_hat_mw").isNotNull()).select(
        "series_id", F.col("target_ts_utc").alias("known_ts_utc"), "y_hat_mw"
    )
    found = asof_join(wanted, good, ["series_id"], "target_ts_utc", "known_ts_utc", max_age_seconds)
    return found.withColumn("is_fallback", F.col("known_ts_utc") < F.col("target_ts_utc"))
