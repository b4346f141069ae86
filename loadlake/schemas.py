"""Declared schemas: landed documents, lake tables, result tables, feature contract."""

from __future__ import annotations

# Fixed values from here on: field names, types, required columns and the feature
# contract are given by the documents and tables this package reads and writes.

# Landed demand document: one day (or part of a day) of one series.
BRONZE_DEMAND = """
    metadata STRUCT<ingested_at_utc STRING, source STRING, filter_id STRING, region STRING,
                    resolution STRING, chunk_timestamp_ms BIGINT, run_date STRING>,
    data ARRAY<STRUCT<ts_ms BIGINT, load_mw DOUBLE>>,
    raw MAP<STRING, STRING>
"""

# Landed weather document: parallel arrays under raw.hourly.
BRONZE_WEATHER = """
    metadata STRUCT<ingested_at_utc STRING, source STRING, location_name STRING, latitude DOUBLE,
                    longitude DOUBLE, run_date STRING, timezone STRING, hourly_vars ARRAY<STRING>>,
    raw MAP<STRING, STRING>
"""

BRONZE_CALENDAR = """
    metadata STRUCT<run_date STRING, generated_at_utc STRING, source STRING, timezone STRING, scope STRING>,
    data ARRAY<STRUCT<dt STRING, day_of_week INT, day_of_month INT, week_of_year INT, month INT, year INT,
                      is_weekend BOOLEAN, is_holiday BOOLEAN, is_working_day BOOLEAN, season STRING>>
"""

WEATHER_VARIABLES = (
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "cloud_cover",
    "precipitation",
    "surface_pressure",
)

WEATHER_HOURLY = "time ARRAY<STRING>, " + ", ".join(f"{v} ARRAY<DOUBLE>" for v in WEATHER_VARIABLES)

SERIES_COLUMNS = ("source", "filter_id", "region", "resolution")

# What a demand row says about itself when its document does not.
SERIES_DEFAULTS = {"source": "smard", "filter_id": "410", "region": "DE", "resolution": "hour"}
DEFAULT_SERIES_ID = "DE"

LABEL = "target_load_mw"

# Required columns per table.
SILVER_DEMAND_REQUIRED = ("event_ts_utc", "dt", "source", "filter_id", "region", "resolution", "load_mw")
SILVER_WEATHER_REQUIRED = ("event_ts_utc", "dt", "location_name", *WEATHER_VARIABLES)
SILVER_CALENDAR_REQUIRED = (
    "dt", "day_of_week", "day_of_month", "week_of_year", "month", "year",
    "is_weekend", "is_holiday", "is_working_day", "season",
)
GOLD_REQUIRED = ("event_ts_utc", "dt", "series_id", "load_mw", LABEL)
GOLD_CRITICAL_FEATURES = ("load_lag_7d", "load_mean_30d_same_hour")

# The serving contract: field name to stored type, entity series_id, 30 days to live.
FEATURE_CONTRACT = {
    "load_mw": "float",
    "load_lag_1h": "float",
    "load_lag_2h": "float",
    "load_lag_3h": "float",
    "load_lag_6h": "float",
    "load_lag_12h": "float",
    "load_lag_24h": "float",
    "load_lag_48h": "float",
    "load_lag_7d": "float",
    "load_lag_14d": "float",
    "load_mean_7d_same_hour": "float",
    "load_mean_30d_same_hour": "float",
    "load_std_30d_same_hour": "float",
    "temperature_2m": "float",
    "temp_lag_24h": "float",
    "temp_mean_7d": "float",
    "heating_degree": "float",
    "cooling_degree": "float",
    "hour": "int",
    "day_of_week": "int",
    "month": "int",
}
FEATURE_TTL_DAYS = 30

# Sub-hourly measurements as they arrive on the stream.
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
