"""Silver to gold: day-ahead features for a range of days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.functions.calendar import clock_columns
from loadlake.functions.timefns import iso_date
from loadlake.operators.history import load_history, weather_history

HISTORY_DAYS = 35


def with_series_id(df: DataFrame) -> DataFrame:
    """``series_id`` from the columns that tell series apart, or the default when there are none.

    With more than the region these are joined by ``/``, so two filters or
    resolutions of one region stay two series.
    """
    if "series_id" in df.columns:
        return df
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.SERIES_COLUMNS if c in df.columns]
    return df.withColumn("series_id", F.concat_ws("/", *parts) if parts else F.lit(schemas.DEFAULT_SERIES_ID))


def one_weather_per_hour(weather: DataFrame, keys: Sequence[str] = ("event_ts_utc",)) -> DataFrame:
    """Means per hour, over locations or (with ``location_name`` as a key) over what landed twice."""
    measured = [c for c in weather.columns if c not in ("event_ts_utc", "dt", "location_name", "latitude", "longitude")]
    return weather.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in measured])


def joined_base(demand: DataFrame, weather: DataFrame, calendar: DataFrame) -> DataFrame:
    """Demand with the weather of its hour, the calendar of its day and clock columns.

    A series with a ``location_name`` takes the weather there; without one,
    the mean over locations. Either way an hour of a series stays one row.
    """
    demand = with_series_id(demand)
    if "location_name" in demand.columns:
        keys = ["location_name", "event_ts_utc"]
    else:
        keys = ["event_ts_utc"]
    weather = one_weather_per_hour(weather, keys)
    return (
        demand.join(weather, keys, "left")
        .join(calendar, "dt", "left")
        .withColumns(clock_columns(F.col("event_ts_utc")))
    )


def day_ahead_features(
    demand: DataFrame,
    weather: DataFrame,
    calendar: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    mode: Literal["train", "serve"] = "train",
    frame: Literal["days", "reference"] = "days",
    history_days: int | None = HISTORY_DAYS,
) -> DataFrame:
    """Gold features of the closed day range.

    The inputs are cut to the range, ``history_days`` before it and one day
    after it, which holds the labels. ``train`` keeps rows with a label and a
    24 h lag; ``serve`` keeps every row, since the newest day has no label yet.

    Load windows run over the narrow demand columns alone. Weather windows run
    once per location, before the join copies weather to its series. The
    calendar is joined last, to the rows that are kept.
    """
    demand = with_series_id(demand)
    if start is not None and history_days is not None:
        first = iso_date(start) - timedelta(days=history_days)
        demand, weather = demand.where(F.col("dt") >= F.lit(first)), weather.where(F.col("dt") >= F.lit(first))
    if end is not None:
        last = iso_date(end) + timedelta(days=1)
        demand, weather = demand.where(F.col("dt") <= F.lit(last)), weather.where(F.col("dt") <= F.lit(last))

    if "location_name" in demand.columns:
        keys = ["location_name", "event_ts_utc"]
        weather = weather_history(one_weather_per_hour(weather, keys))
    else:
        keys = ["event_ts_utc"]
        weather = weather_history(one_weather_per_hour(weather), keys=())

    rows = load_history(demand.withColumns(clock_columns(F.col("event_ts_utc"))), frame)
    if start is not None:
        rows = rows.where(F.col("dt") >= F.lit(iso_date(start)))
    if end is not None:
        rows = rows.where(F.col("dt") <= F.lit(iso_date(end)))
    if mode == "train":
        rows = rows.where(F.col(schemas.LABEL).isNotNull() & F.col("load_lag_24h").isNotNull())

    joined = rows.join(weather, keys, "left").join(calendar, "dt", "left")
    degrees = [c for c in ("heating_degree", "cooling_degree") if c in joined.columns]
    return joined.na.fill(0.0, degrees) if degrees else joined
