"""Lag, lead and rolling features by time.

A lag is the value at that time before, and NULL if there is no row then: a
gap, a late series or a doubled hour shifts nothing. Of several rows of one
time the largest value counts. All windows of one kind sit in one ``select``:
one shuffle by (series, block), one sort in time order and one per hour of day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loadlake.functions.timefns import DAY, HOUR
from loadlake.functions.weather import cooling_degree, heating_degree
from loadlake.operators.blocks import block_window, own_rows, with_blocks

# Feature name to lag in rows.
LOAD_LAGS = {
    "load_lag_1h": 1,
    "load_lag_2h": 2,
    "load_lag_3h": 3,
    "load_lag_6h": 6,
    "load_lag_12h": 12,
    "load_lag_24h": 24,
    "load_lag_48h": 48,
    "load_lag_7d": 168,
    "load_lag_14d": 336,
}

# The short and the long same-hour frame: days, or for "reference"
# rows, of which it counts hours although they are days; it needs a gap-free grid.
SAME_HOUR_FRAMES = {"days": (7, 30), "reference": (168, 720)}

TEMPERATURE_LAG = 24
TEMPERATURE_FRAME = 168
LABEL_LEAD = 24


def value_at(w: WindowSpec, hours: int, value: str | Column = "load_mw") -> Column:
    """The value ``hours`` later, or earlier if negative; ``w`` is ordered by seconds."""
    return F.max(value).over(w.rangeBetween(hours * HOUR, hours * HOUR))


def lag_columns(w: WindowSpec, value: str = "load_mw") -> dict[str, Column]:
    return {name: value_at(w, -n, value) for name, n in LOAD_LAGS.items()}


def same_hour_columns(w: WindowSpec, frame: str, value: str = "load_mw") -> dict[str, Column]:
    short, long = SAME_HOUR_FRAMES[frame]
    if frame == "reference":
        before, month = w.rowsBetween(-short, -1), w.rowsBetween(-long, -1)
    else:
        before, month = w.rangeBetween(-short * DAY, -1), w.rangeBetween(-long * DAY, -1)
    return {
        "load_mean_7d_same_hour": F.avg(value).over(before),
        "load_mean_30d_same_hour": F.avg(value).over(month),
        "load_std_30d_same_hour": F.stddev(value).over(month),
    }


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def load_lags(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "event_ts_utc") -> DataFrame:
    """The nine load lags, by time."""
    before = max(LOAD_LAGS.values()) * HOUR
    blocked = with_blocks(df, ts, 4 * before, before)
    return own_rows(blocked.select("*", *_aliased(lag_columns(block_window(keys, ts)))))


def same_hour_stats(
    df: DataFrame, frame: str = "days", keys: Sequence[str] = ("series_id",), ts: str = "event_ts_utc"
) -> DataFrame:
    """Mean and deviation of earlier days at the same hour."""
    before = SAME_HOUR_FRAMES[frame][1] * DAY
    blocked = with_blocks(df.withColumn("hour", F.hour(ts)), ts, 4 * before, before)
    return own_rows(blocked.select("*", *_aliased(same_hour_columns(block_window(keys, ts, "hour"), frame))))


def load_history(
    df: DataFrame, frame: str = "days", keys: Sequence[str] = ("series_id",), ts: str = "event_ts_utc"
) -> DataFrame:
    """Lags, same-hour statistics and the label of ``df``, which has an ``hour`` column."""
    before = max(max(LOAD_LAGS.values()) * HOUR, SAME_HOUR_FRAMES[frame][1] * DAY)
    blocked = with_blocks(df, ts, 4 * before, before, LABEL_LEAD * HOUR)
    in_time = block_window(keys, ts)
    lagged = blocked.select(
        "*",
        *_aliased(lag_columns(in_time)),
        value_at(in_time, LABEL_LEAD).alias("target_load_mw"),
    )
    return own_rows(lagged.select("*", *_aliased(same_hour_columns(block_window(keys, ts, "hour"), frame))))


def weather_history(
    df: DataFrame, keys: Sequence[str] = ("location_name",), ts: str = "event_ts_utc"
) -> DataFrame:
    """Temperature lag, 7-day mean and degree hours; no change without a temperature column."""
    if "temperature_2m" not in df.columns:
        return df
    before = TEMPERATURE_FRAME * HOUR
    w = block_window(keys, ts)
    temperature = F.col("temperature_2m")
    blocked = with_blocks(df, ts, 8 * before, before)
    return own_rows(
        blocked.select(
            "*",
            value_at(w, -TEMPERATURE_LAG, temperature).alias("temp_lag_24h"),
            F.avg(temperature).over(w.rangeBetween(-TEMPERATURE_FRAME * HOUR, -1)).alias("temp_mean_7d"),
            heating_degree(temperature).alias("heating_degree"),
            cooling_degree(temperature).alias("cooling_degree"),
        )
    )
