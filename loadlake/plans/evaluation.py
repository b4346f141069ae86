"""Forecast evaluation: quantile losses, backtests, segments, comparisons, intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.functions import accuracy
from loadlake.functions.calendar import season
from loadlake.functions.timefns import DAY, HOUR
from loadlake.operators.blocks import block_window, own_rows, with_blocks
from loadlake.plans.monitoring import accuracy_columns

QUANTILES = (0.1, 0.5, 0.9)
PEAK_HOURS = (8, 20)


def quantile_name(prefix: str, q: float) -> str:
    return f"{prefix}_p{round(q * 100)}"


def shifted(ts: str, seconds: int) -> Column:
    return F.timestamp_seconds(F.unix_seconds(F.col(ts)) + seconds)


def pinball(pairs: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Pinball loss per key. A point forecast serves as every quantile; ``y_hat_p10`` etc. are used if present."""
    losses = []
    for q in quantiles:
        column = quantile_name("y_hat", q)
        y_hat = F.col(column if column in pairs.columns else "y_hat_mw")
        losses.append(accuracy.pinball(F.col("load_mw"), y_hat, q).alias(quantile_name("pinball", q)))
    return pairs.groupBy(*keys).agg(*losses)


def smape(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pairs.groupBy(*keys).agg(accuracy.smape(F.col("load_mw"), F.col("y_hat_mw")).alias("smape"))


def horizon_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy per horizon."""
    return pairs.groupBy("series_id", "horizon_hours").agg(*accuracy_columns(F.col("load_mw"), F.col("y_hat_mw")))


def rolling_origin(demand: DataFrame, first: Column, last: Column, step_days: int = 1, horizon_days: int = 3) -> DataFrame:
    """Seasonal-naive backtest from every ``step_days``-th origin of [first, last].

    An origin is the start of a day. The forecast for the h-th day after it
    is the load at the same hour h days earlier, the last day known at the
    origin. A row names the origins whose horizon covers it, so nothing is
    compared by range.
    """
    covered = F.filter(
        F.sequence(F.lit(1), F.lit(horizon_days)),
        lambda h: F.date_sub("dt", h - 1).between(first, last)
        & (F.pmod(F.datediff(F.date_sub("dt", h - 1), first), F.lit(step_days)) == 0),
    )
    targets = demand.select("series_id", "event_ts_utc", "dt", "load_mw", F.explode(covered).alias("horizon_day")).select(
        "series_id",
        F.timestamp_seconds(F.unix_seconds("event_ts_utc") - F.col("horizon_day") * DAY).alias("known_ts"),
        F.date_sub("dt", F.col("horizon_day") - 1).alias("origin"),
        "horizon_day",
        "load_mw",
    )
    known = demand.select("series_id", F.col("event_ts_utc").alias("known_ts"), F.col("load_mw").alias("y_hat_mw"))
    pairs = targets.join(known, ["series_id", "known_ts"]).where(
        F.col("load_mw").isNotNull() & F.col("y_hat_mw").isNotNull()
    )
    return pairs.groupBy("series_id", "origin", "horizon_day").agg(
        accuracy.mae(F.col("load_mw"), F.col("y_hat_mw")).alias("mae"),
        accuracy.rmse(F.col("load_mw"), F.col("y_hat_mw")).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
        F.max("known_ts").alias("last_known_ts"),
    )


def segment_metrics(pairs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Accuracy by peak hours, by season, by working day, by holiday, and over everything."""
    hour = F.hour("target_ts_utc")
    rows = (
        pairs.join(calendar.select(F.col("dt").alias("target_date"), "is_working_day", "is_holiday"), "target_date", "left")
        .withColumn("is_peak", (hour >= PEAK_HOURS[0]) & (hour < PEAK_HOURS[1]))
        .withColumn("season", season(F.month("target_date")))
    )
    segments = ["is_peak", "season", "is_working_day", "is_holiday"]
    columns = [F.col(s) for s in segments]
    return rows.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        *accuracy_columns(F.col("load_mw"), F.col("y_hat_mw"))
    )


def baseline_degradation(pairs: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("series_id",), quantile: float = 0.5) -> DataFrame:
    """Pinball loss relative to a baseline's on the same target hours; 0.1 means 10 % worse."""
    same_rows = ["series_id", "target_ts_utc"]
    joined = pairs.join(baseline.select(*same_rows, F.col("y_hat_mw").alias("_base")), same_rows)
    loss = accuracy.pinball(F.col("load_mw"), F.col("y_hat_mw"), quantile)
    base = accuracy.pinball(F.col("load_mw"), F.col("_base"), quantile)
    return joined.groupBy(*keys).agg(
        loss.alias("pinball"), base.alias("pinball_baseline"), (loss / F.nullif(base, F.lit(0.0)) - 1).alias("degradation")
    )


def shadow_compare(pairs: DataFrame, current: str, candidate: str, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Two models side by side over the target hours that both have scored."""
    both = (
        pairs.where(F.col("model_name").isin(current, candidate))
        .groupBy("series_id", "target_date", "target_ts_utc")
        .agg(
            F.max("load_mw").alias("load_mw"),
            F.max(F.when(F.col("model_name") == current, F.col("y_hat_mw"))).alias("_current"),
            F.max(F.when(F.col("model_name") == candidate, F.col("y_hat_mw"))).alias("_candidate"),
        )
        .where(F.col("_current").isNotNull() & F.col("_candidate").isNotNull())
    )
    y = F.col("load_mw")
    return (
        both.groupBy(*keys)
        .agg(
            accuracy.mae(y, F.col("_current")).alias("mae_current"),
            accuracy.mae(y, F.col("_candidate")).alias("mae_candidate"),
            accuracy.rmse(y, F.col("_current")).alias("rmse_current"),
            accuracy.rmse(y, F.col("_candidate")).alias("rmse_candidate"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("candidate_better", F.col("rmse_candidate") < F.col("rmse_current"))
    )


def residual_intervals(
    pairs: DataFrame, quantiles: Sequence[float] = QUANTILES, days: int = 28, horizon_hours: int = 24
) -> DataFrame:
    """Forecasts with quantiles of the residuals known before their origin.

    For a target hour t the residuals of the same hour of day count whose
    target lies before the origin t - ``horizon_hours`` and at most ``days``
    days before t. A frame holds at most one residual per day.
    """
    rows = pairs.withColumns({"residual": F.col("load_mw") - F.col("y_hat_mw"), "hour": F.hour("target_ts_utc")})
    before = days * DAY
    w = block_window(["series_id"], "target_ts_utc", "hour").rangeBetween(-before, -horizon_hours * HOUR - 1)
    spread = F.percentile("residual", F.array(*[F.lit(q) for q in quantiles])).over(w)
    blocked = with_blocks(rows, "target_ts_utc", 4 * before, before)
    scored = own_rows(blocked.select("*", spread.alias("_q"), F.count("residual").over(w).alias("n_residuals")))
    return scored.where(F.col("n_residuals") > 0).select(
        "series_id",
        "target_ts_utc",
        "target_date",
        "load_mw",
        "y_hat_mw",
        "n_residuals",
        *[(F.col("y_hat_mw") + F.get("_q", F.lit(i))).alias(quantile_name("y_hat", q)) for i, q in enumerate(quantiles)],
    )


def leaks(samples: DataFrame, feature_ts: str, origin_ts: str) -> DataFrame:
    """Rows whose features are newer than their origin; there should be none."""
    return samples.where(F.col(feature_ts) > F.col(origin_ts))


def seasonal_naive(demand: DataFrame, lag_hours: int = 24, horizon_hours: int = 24, model_name: str = "seasonal_naive") -> DataFrame:
    """Forecasts that repeat the load ``lag_hours`` before the target hour."""
    origin = shifted("event_ts_utc", (lag_hours - horizon_hours) * HOUR)
    target = shifted("event_ts_utc", lag_hours * HOUR)
    return demand.where(F.col("load_mw").isNotNull()).select(
        F.to_date(origin).alias("forecast_run_date"),
        F.to_date(target).alias("target_date"),
        origin.alias("event_ts_utc"),
        target.alias("target_ts_utc"),
        "series_id",
        F.col("load_mw").alias("y_hat_mw"),
        F.lit(model_name).alias("model_name"),
        F.lit(horizon_hours).alias("horizon_hours"),
    )
