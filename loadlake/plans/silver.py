"""Bronze to silver: gap-free demand, gap-free weather, calendar."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.functions.calendar import day_columns
from loadlake.functions.timefns import as_date, iso_date, local_day
from loadlake.operators.grid import day_span, fill_grid, join_grid
from loadlake.sources import bronze


def silver_demand(
    documents: DataFrame, start: date | str, end: date | str, series: DataFrame | None = None, zone: str = "UTC"
) -> DataFrame:
    """24 rows per (series, day) of the range: the largest value of the hour, NULL in a gap.

    ``series`` holds series to expect (``source, filter_id, region,
    resolution``), best the silver table so far: a series that sent nothing in
    the range still gets its rows. Those seen in the range always do. With
    another ``zone`` the days are local ones, with 23 or 25 rows when the
    clocks change; timestamps stay UTC.
    """
    margin = timedelta(days=0 if zone == "UTC" else 1)
    points = bronze.demand_points(documents, iso_date(start) - margin, iso_date(end) + margin)
    points = points.withColumn("event_ts_utc", F.date_trunc("hour", "event_ts_utc"))
    first, last = day_span(start, end, zone)
    filled = fill_grid(points, schemas.SERIES_COLUMNS, first, last, series=series)
    return filled.select(
        "event_ts_utc", local_day(F.col("event_ts_utc"), zone).alias("dt"), *schemas.SERIES_COLUMNS, "load_mw"
    )


def silver_weather(
    documents: DataFrame, start: date | str, end: date | str, locations: DataFrame | None = None
) -> DataFrame:
    """24 rows per (location, day) of the range, NULL variables in a gap.

    Each location keeps its own coordinates, the first ones. Coordinates stay
    out of the join key. ``locations`` holds ``location_name, latitude,
    longitude`` to expect, best the silver table so far: a location that sent
    nothing in the range still gets its rows.
    """
    hours = bronze.weather_hours(documents, start, end)
    seen = hours.select("location_name", "latitude", "longitude", "event_ts_utc")
    if locations is not None:
        earlier = locations.select("location_name", "latitude", "longitude", F.to_timestamp(F.lit("0001-01-01")).alias("event_ts_utc"))
        seen = seen.unionByName(earlier)
    locations = seen.groupBy("location_name").agg(
        F.min_by("latitude", "event_ts_utc").alias("latitude"),
        F.min_by("longitude", "event_ts_utc").alias("longitude"),
    )
    first, last = day_span(start, end)
    filled = join_grid(hours.drop("latitude", "longitude", "dt"), locations, ["location_name"], first, last)
    return filled.select(
        "event_ts_utc",
        F.to_date("event_ts_utc").alias("dt"),
        "location_name",
        "latitude",
        "longitude",
        *schemas.WEATHER_VARIABLES,
    )


def calendar_days(
    spark: SparkSession, start: date | str | Column, end: date | str | Column, holidays: DataFrame | None = None
) -> DataFrame:
    """The derived calendar of a closed date range, one row per day."""
    days = spark.range(1).select(F.explode(F.sequence(as_date(start), as_date(end))).alias("dt"))
    return with_day_columns(days, holidays)


def with_day_columns(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar attributes of each ``dt``; ``holidays`` lists days (``dt``) off."""
    is_holiday = None
    if holidays is not None:
        marked = holidays.select("dt").distinct().withColumn("_holiday", F.lit(True))
        days, is_holiday = days.join(marked, "dt", "left"), F.col("_holiday")
    return days.withColumns(day_columns(F.col("dt"), is_holiday)).drop("_holiday")


def silver_calendar(documents: DataFrame) -> DataFrame:
    """Typed calendar rows of bronze documents as read by ``bronze.read_calendar``."""
    return documents.select(F.to_date("dt").alias("dt"), *schemas.SILVER_CALENDAR_REQUIRED[1:])
