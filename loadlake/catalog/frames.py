"""Demand, weather, calendar and forecast frames derived from the test tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.operators.grid import fill_grid, join_grid
from loadlake.operators.history import SAME_HOUR_FRAMES
from loadlake.plans.evaluation import seasonal_naive
from loadlake.plans.gold import day_ahead_features
from loadlake.plans.silver import calendar_days
from loadlake.sources import tables

ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING"
LINEITEM = "l_returnflag STRING, l_shipdate TIMESTAMP"

# Hourly weather made from event values: variable to (modulus, offset).
WEATHER_SCALES = {
    "temperature_2m": (40, 0),
    "relative_humidity_2m": (100, 0),
    "wind_speed_10m": (25, 0),
    "cloud_cover": (90, 0),
    "precipitation": (5, 0),
    "surface_pressure": (80, 950),
}
SITE = ("site0", 52.52, 13.405)


def day_bounds(df: DataFrame, ts: str) -> tuple[date, date]:
    """First and last day of a table, one row to the driver."""
    row = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b")).first()
    return row.a, row.b


class Frames:
    """The frames of one query.

    The events are read once, into a stored table of one row per (series,
    hour); everything else derives from that, however often it is used. Ask
    for weather before demand, so that one table serves both.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @property
    def events(self) -> DataFrame:
        return self.spark.read.schema(schemas.EVENTS).parquet(f"{self.sf_dir}/events.parquet")

    @property
    def orders(self) -> DataFrame:
        return self.spark.read.schema(ORDERS).parquet(f"{self.sf_dir}/orders.parquet")

    @property
    def lineitem(self) -> DataFrame:
        return self.spark.read.schema(LINEITEM).parquet(f"{self.sf_dir}/lineitem.parquet")

    @property
    def runs(self) -> DataFrame:
        """A run log from orders; status F stands for an approved, successful run."""
        good = F.col("o_orderstatus") == "F"
        return self.orders.select(
            F.col("o_orderkey").alias("run_id"),
            F.col("o_totalprice").alias("rmse"),
            F.when(good, "approved").otherwise("rejected").alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )

    def _rollup(self, *extra: Column) -> DataFrame:
        return self.events.groupBy(
            F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("event_ts_utc")
        ).agg(F.max("value").alias("load_mw"), *extra)

    @cached_property
    def hourly_weather(self) -> DataFrame:
        """Largest value, count and sums for the weather per (series, hour), in whole cents to be exact."""
        sums = [
            F.sum(F.round((F.col("value") % modulus) * 100).cast("bigint")).alias(name)
            for name, (modulus, _) in WEATHER_SCALES.items()
        ]
        return tables.stored(self._rollup(F.count("value").alias("n"), *sums), "hourly")

    @cached_property
    def hourly(self) -> DataFrame:
        """Largest value per (series, hour), out of the table with the weather if there is one."""
        if "hourly_weather" in self.__dict__:
            return self.hourly_weather.select("series_id", "event_ts_utc", "load_mw")
        return tables.stored(self._rollup(), "hourly")

    @cached_property
    def hour_bounds(self) -> tuple[datetime, datetime]:
        row = self.hourly.agg(F.min("event_ts_utc").alias("a"), F.max("event_ts_utc").alias("b")).first()
        return row.a, row.b

    @property
    def first_day(self) -> date:
        return self.hour_bounds[0].date()

    @property
    def last_day(self) -> date:
        return self.hour_bounds[1].date()

    @property
    def run_day(self) -> date:
        """The newest day whose following day has data."""
        return self.last_day - timedelta(days=1)

    @property
    def demand(self) -> DataFrame:
        """One series per event type, hourly largest value, gaps filled on the common grid."""
        filled = fill_grid(self.hourly, ["series_id"], *map(F.lit, self.hour_bounds))
        return filled.select("event_ts_utc", F.to_date("event_ts_utc").alias("dt"), "series_id", "load_mw")

    @property
    def weather(self) -> DataFrame:
        """One location, means over the events of the hour."""
        measured = [
            (F.sum(name) / (F.sum("n") * 100) + offset).alias(name) for name, (_, offset) in WEATHER_SCALES.items()
        ]
        name, latitude, longitude = SITE
        return self.hourly_weather.groupBy("event_ts_utc").agg(*measured).select(
            "event_ts_utc",
            F.to_date("event_ts_utc").alias("dt"),
            F.lit(name).alias("location_name"),
            F.lit(latitude).alias("latitude"),
            F.lit(longitude).alias("longitude"),
            *WEATHER_SCALES,
        )

    @property
    def weather_filled(self) -> DataFrame:
        """The weather on the common grid, NULL in a gap."""
        site = self.spark.range(1).select(F.lit(SITE[0]).alias("location_name"))
        rows = self.weather.drop("dt")
        filled = join_grid(rows, site, ["location_name"], *map(F.lit, self.hour_bounds))
        return filled.withColumn("dt", F.to_date("event_ts_utc"))

    @property
    def calendar(self) -> DataFrame:
        return calendar_days(self.spark, self.first_day, self.last_day)

    def gold(self, mode: str = "train", frame: str = "days", start: date | None = None, end: date | None = None) -> DataFrame:
        history = None if start is None else max(SAME_HOUR_FRAMES[frame]) + 1
        weather = self.weather_filled
        return day_ahead_features(
            self.demand, weather, self.calendar, start, end, mode=mode, frame=frame, history_days=history
        )

    @property
    def forecasts(self) -> DataFrame:
        return seasonal_naive(self.demand)

    @property
    def candidates(self) -> DataFrame:
        """The same hour of the week before, as a second model."""
        return seasonal_naive(self.demand, lag_hours=168, model_name="weekly_naive")

    @property
    def actuals(self) -> DataFrame:
        return self.demand.where(F.col("load_mw").isNotNull())


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Floating sums depend on their order, so results are compared to ``places`` decimals."""
    return df.withColumns({c: F.round(c, places) for c in columns})


# The same frames for the oracle, as common table expressions.
_WEATHER_SQL = ",\n    ".join(
    f"CAST(sum(CAST(round((value % {m}) * 100) AS BIGINT)) AS DOUBLE) / (count(value) * 100) + {o} AS {name}"
    for name, (m, o) in WEATHER_SCALES.items()
)

SQL = f"""WITH hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS event_ts_utc FROM events
), demand AS (
  SELECT g.event_ts_utc, CAST(g.event_ts_utc AS DATE) AS dt, s.event_type AS series_id, r.load_mw
  FROM hours g CROSS JOIN (SELECT DISTINCT event_type FROM events) s
  LEFT JOIN (SELECT date_trunc('hour', ts) AS h, event_type, max(value) AS load_mw FROM events GROUP BY ALL) r
    ON r.h = g.event_ts_utc AND r.event_type = s.event_type
), weather AS (
  SELECT date_trunc('hour', ts) AS event_ts_utc, CAST(date_trunc('hour', ts) AS DATE) AS dt,
    'site0' AS location_name, 52.52::DOUBLE AS latitude, 13.405::DOUBLE AS longitude,
    {_WEATHER_SQL}
  FROM events GROUP BY ALL
), calendar AS (
  SELECT dt, CAST(isodow(dt) - 1 AS INT) AS day_of_week, CAST(day(dt) AS INT) AS day_of_month,
    CAST(weekofyear(dt) AS INT) AS week_of_year, CAST(month(dt) AS INT) AS month, CAST(year(dt) AS INT) AS year,
    isodow(dt) >= 6 AS is_weekend, false AS is_holiday, isodow(dt) < 6 AS is_working_day,
    CASE WHEN month(dt) IN (12,1,2) THEN 'winter' WHEN month(dt) IN (3,4,5) THEN 'spring'
         WHEN month(dt) IN (6,7,8) THEN 'summer' ELSE 'autumn' END AS season
  FROM (SELECT DISTINCT dt FROM demand)
), base AS (
  SELECT d.event_ts_utc, d.dt, d.series_id, d.load_mw,
    {", ".join("w." + v for v in WEATHER_SCALES)},
    c.* EXCLUDE (dt),
    CAST(hour(d.event_ts_utc) AS INT) AS hour, CAST(minute(d.event_ts_utc) AS INT) AS minute,
    CAST(dayofweek(d.event_ts_utc) + 1 AS INT) AS day_of_week_ts
  FROM demand d LEFT JOIN weather w ON w.event_ts_utc = d.event_ts_utc LEFT JOIN calendar c ON c.dt = d.dt
), gold AS (
  SELECT *,
    lag(load_mw, 1) OVER w AS load_lag_1h, lag(load_mw, 2) OVER w AS load_lag_2h, lag(load_mw, 3) OVER w AS load_lag_3h,
    lag(load_mw, 6) OVER w AS load_lag_6h, lag(load_mw, 12) OVER w AS load_lag_12h, lag(load_mw, 24) OVER w AS load_lag_24h,
    lag(load_mw, 48) OVER w AS load_lag_48h, lag(load_mw, 168) OVER w AS load_lag_7d, lag(load_mw, 336) OVER w AS load_lag_14d,
    round(avg(load_mw) OVER (h ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS load_mean_7d_same_hour,
    round(avg(load_mw) OVER (h ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS load_mean_30d_same_hour,
    round(stddev_samp(load_mw) OVER (h ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS load_std_30d_same_hour,
    lag(temperature_2m, 24) OVER w AS temp_lag_24h,
    round(avg(temperature_2m) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS temp_mean_7d,
    CASE WHEN temperature_2m < 18 THEN 18 - temperature_2m ELSE 0.0 END AS heating_degree,
    CASE WHEN temperature_2m > 22 THEN temperature_2m - 22 ELSE 0.0 END AS cooling_degree,
    lead(load_mw, 24) OVER w AS target_load_mw
  FROM base
  WINDOW w AS (PARTITION BY series_id ORDER BY event_ts_utc), h AS (PARTITION BY series_id, hour ORDER BY event_ts_utc)
), gold_train AS (
  SELECT * FROM gold WHERE target_load_mw IS NOT NULL AND load_lag_24h IS NOT NULL
), forecasts AS (
  SELECT CAST(event_ts_utc AS DATE) AS forecast_run_date, CAST(event_ts_utc + INTERVAL 24 HOUR AS DATE) AS target_date,
    event_ts_utc, event_ts_utc + INTERVAL 24 HOUR AS target_ts_utc, series_id, load_mw AS y_hat_mw,
    'seasonal_naive' AS model_name, 24 AS horizon_hours
  FROM demand WHERE load_mw IS NOT NULL
), candidates AS (
  SELECT CAST(event_ts_utc + INTERVAL 144 HOUR AS DATE) AS forecast_run_date,
    CAST(event_ts_utc + INTERVAL 168 HOUR AS DATE) AS target_date,
    event_ts_utc + INTERVAL 144 HOUR AS event_ts_utc, event_ts_utc + INTERVAL 168 HOUR AS target_ts_utc,
    series_id, load_mw AS y_hat_mw, 'weekly_naive' AS model_name, 24 AS horizon_hours
  FROM demand WHERE load_mw IS NOT NULL
), actuals AS (
  SELECT event_ts_utc, series_id, load_mw, dt FROM demand WHERE load_mw IS NOT NULL
), pairs AS (
  SELECT f.*, a.load_mw FROM forecasts f JOIN actuals a ON a.series_id = f.series_id AND a.event_ts_utc = f.target_ts_utc
), candidate_pairs AS (
  SELECT f.*, a.load_mw FROM candidates f JOIN actuals a ON a.series_id = f.series_id AND a.event_ts_utc = f.target_ts_utc
), run AS (
  SELECT CAST(max(ts) AS DATE) - 1 AS d FROM events
)"""

GOLD_ROUNDED = (
    "load_mean_7d_same_hour", "load_mean_30d_same_hour", "load_std_30d_same_hour", "temp_mean_7d",
)
GOLD_COLUMNS = (
    "event_ts_utc", "dt", "series_id", "load_mw", *WEATHER_SCALES,
    "day_of_week", "day_of_month", "week_of_year", "month", "year", "is_weekend", "is_holiday", "is_working_day", "season",
    "hour", "minute", "day_of_week_ts",
    "load_lag_1h", "load_lag_2h", "load_lag_3h", "load_lag_6h", "load_lag_12h", "load_lag_24h", "load_lag_48h",
    "load_lag_7d", "load_lag_14d", *GOLD_ROUNDED, "temp_lag_24h", "heating_degree", "cooling_degree", "target_load_mw",
)


def with_frames(sql: str) -> str:
    return f"{SQL}\n{sql.strip()}"
