"""Check tables over whole tables with deliberate faults in them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.catalog.frames import Frames, with_frames
from loadlake.catalog.registry import query
from loadlake.operators import quality


def broken_demand(f: Frames) -> DataFrame:
    """Demand with, every month, a doubled hour (2nd), a lost hour (3rd), a negative load (4th) and a wrong day (5th)."""
    day, hour = F.dayofmonth("event_ts_utc"), F.hour("event_ts_utc")
    demand = f.demand.select(
        "event_ts_utc",
        F.when((day == 5) & (hour == 3), F.date_add("dt", 1)).otherwise(F.col("dt")).alias("dt"),
        F.lit("events").alias("source"),
        F.lit("410").alias("filter_id"),
        F.col("series_id").alias("region"),
        F.when((day == 4) & (hour == 9), -F.col("load_mw")).otherwise(F.col("load_mw")).alias("load_mw"),
    )
    copies = F.when((day == 2) & (hour == 5), 2).when((day == 3) & (hour == 7), 0).otherwise(1)
    return demand.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")


_BROKEN_SQL = """, broken AS (
  SELECT event_ts_utc, CASE WHEN day(event_ts_utc) = 5 AND hour(event_ts_utc) = 3 THEN dt + 1 ELSE dt END AS dt, series_id AS region,
    CASE WHEN day(event_ts_utc) = 4 AND hour(event_ts_utc) = 9 THEN -load_mw ELSE load_mw END AS load_mw
  FROM demand WHERE NOT (day(event_ts_utc) = 3 AND hour(event_ts_utc) = 7)
), delivered AS (
  SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE day(event_ts_utc) = 2 AND hour(event_ts_utc) = 5
)"""


def _checks_sql(table: str, entity: str | None, checks: list[tuple[str, str, str]], expected: str | None = None) -> str:
    """Oracle for a check table: aggregate once per key, then one row per check."""
    keys = "dt" if entity is None else f"dt, {entity}"
    unique = "dt" if entity is None else "event_ts_utc"
    counters = ", ".join(f"count(*) FILTER (WHERE {p}) AS c{i}" for i, (_, _, p) in enumerate(checks))
    zeros = ", ".join(f"coalesce(a.c{i}, 0) AS c{i}" for i in range(len(checks)))
    source = f"(SELECT {keys}, coalesce(a.n, 0) AS n, coalesce(a.u, 0) AS u, {zeros} FROM ({expected or f'SELECT DISTINCT {keys} FROM {table}'}) e LEFT JOIN a USING ({keys}))"
    rows_name, per_key, severity = ("rows_1", 1, "hard") if entity is None else ("rows_24", 24, "soft")
    selects = [
        ("present", "hard", "CASE WHEN n = 0 THEN 1 ELSE 0 END"),
        (f"unique_{unique}", "hard", "n - u"),
        (rows_name, severity, f"abs(n - {per_key})"),
    ] + [(name, sev, f"c{i}") for i, (name, sev, _) in enumerate(checks)]
    body = "\nUNION ALL ".join(
        f"SELECT {keys}, '{name}' AS \"check\", '{sev}' AS severity, CAST({expr} AS BIGINT) AS violations, ({expr}) = 0 AS passed FROM f"
        for name, sev, expr in selects
    )
    return (
        f", a AS (SELECT {keys}, count(*) AS n, count(DISTINCT {unique}) AS u, {counters} FROM {table} GROUP BY {keys})"
        f", f AS {source}\n{body}"
    )


_WRONG_DAY = "dt IS DISTINCT FROM CAST(event_ts_utc AS DATE)"
_DEMAND_CHECKS = [
    ("event_ts_utc_not_null", "hard", "event_ts_utc IS NULL"),
    ("dt_matches", "hard", _WRONG_DAY),
    ("load_mw_not_null", "soft", "load_mw IS NULL"),
    ("load_mw_not_negative", "soft", "load_mw < 0"),
]
_EXPECTED = """SELECT CAST(unnest(generate_series(a, b + 1, INTERVAL 1 DAY)) AS DATE) AS dt, region
  FROM (SELECT series_id AS region, CAST(min(dt) AS TIMESTAMP) AS a, max(dt) AS b FROM demand GROUP BY series_id)"""
_DEMAND_SQL = (
    _BROKEN_SQL
    + _checks_sql("delivered", "region", _DEMAND_CHECKS, _EXPECTED)
    + "\nUNION ALL SELECT dt, region, 'required_columns', 'hard', CAST(1 AS BIGINT), false FROM f"
)


def _expected_days(f: Frames) -> DataFrame:
    """Every (day, region) of the data and of the day after it, for which nothing came."""
    regions = f.hourly.select(F.col("series_id").alias("region")).distinct()
    days = F.sequence(F.lit(f.first_day), F.lit(f.last_day + timedelta(days=1)))
    return regions.select(F.explode(days).alias("dt"), "region")


@query("quality_demand", with_frames(_DEMAND_SQL))
def quality_demand(f):
    """One column is missing as well. The rows differ in their region only, so it names the series."""
    checks = quality.check_silver_demand(broken_demand(f), expected=_expected_days(f))
    return checks.select("dt", "region", "check", "severity", "violations", "passed")


@query(
    "quality_verdicts",
    with_frames(
        _BROKEN_SQL
        + _checks_sql("delivered", "region", _DEMAND_CHECKS, _EXPECTED).replace("\nSELECT", "\n, c AS (SELECT", 1)
        + """)
      SELECT dt, CASE WHEN count(*) FILTER (WHERE severity = 'hard' AND NOT passed) > 0 THEN 'fail'
                      WHEN count(*) FILTER (WHERE NOT passed) > 0 THEN 'warn' ELSE 'pass' END AS verdict,
        count(*) FILTER (WHERE severity = 'hard' AND NOT passed) AS hard_failures,
        count(*) FILTER (WHERE severity = 'soft' AND NOT passed) AS soft_failures
      FROM c GROUP BY dt"""
    ),
)
def quality_verdicts(f):
    """Lenient gate over the same demand with all its columns."""
    whole = broken_demand(f).withColumn("resolution", F.lit("hour"))
    checks = quality.check_silver_demand(whole, expected=_expected_days(f))
    return quality.day_verdicts(checks, strict=False)


_WEATHER_CHECKS = [
    ("event_ts_utc_not_null", "hard", "event_ts_utc IS NULL"),
    ("dt_matches", "hard", _WRONG_DAY),
    *[(f"{v}_not_null", "soft", f"{v} IS NULL") for v in schemas.WEATHER_VARIABLES],
]


@query(
    "quality_weather",
    with_frames(
        """, faulty AS (SELECT event_ts_utc, dt, location_name, """
        + ", ".join(f"CASE WHEN hour(event_ts_utc) < 3 THEN NULL ELSE {v} END AS {v}" for v in schemas.WEATHER_VARIABLES)
        + " FROM weather)"
        + _checks_sql("faulty", "location_name", _WEATHER_CHECKS)
        + "\nUNION ALL SELECT dt, location_name, 'required_columns', 'hard', CAST(0 AS BIGINT), true FROM f"
    ),
)
def quality_weather(f):
    """The first three hours of each day have no values."""
    blank = F.hour("event_ts_utc") < 3
    faulty = f.weather.withColumns(
        {v: F.when(~blank, F.col(v)) for v in schemas.WEATHER_VARIABLES}
    )
    return quality.check_silver_weather(faulty)


_CALENDAR_CHECKS = [
    ("dt_matches", "hard", "dt IS NULL"),
    *[(f"{c}_not_null", "hard", f"{c} IS NULL") for c in schemas.SILVER_CALENDAR_REQUIRED],
]


@query(
    "quality_calendar",
    with_frames(
        """, faulty AS (SELECT * REPLACE (CASE WHEN day_of_month = 2 THEN NULL ELSE season END AS season) FROM calendar
             UNION ALL SELECT * FROM calendar WHERE day_of_month = 3)"""
        + _checks_sql("faulty", None, _CALENDAR_CHECKS)
        + "\nUNION ALL SELECT dt, 'required_columns', 'hard', CAST(0 AS BIGINT), true FROM f"
    ),
)
def quality_calendar(f):
    """A month's 2nd lacks its season and its 3rd comes twice."""
    calendar = f.calendar
    faulty = calendar.withColumn("season", F.when(F.col("day_of_month") != 2, F.col("season")))
    return quality.check_silver_calendar(faulty.unionByName(calendar.where(F.col("day_of_month") == 3)))


_GOLD_CHECKS = [
    ("event_ts_utc_not_null", "hard", "event_ts_utc IS NULL"),
    ("dt_matches", "hard", _WRONG_DAY),
    ("series_id_not_null", "hard", "series_id IS NULL"),
    ("load_mw_not_null", "soft", "load_mw IS NULL"),
    ("target_load_mw_not_null", "soft", "target_load_mw IS NULL"),
    ("load_mw_not_negative", "soft", "load_mw < 0"),
    ("load_lag_7d_not_null", "soft", "load_lag_7d IS NULL"),
    ("load_mean_30d_same_hour_not_null", "soft", "load_mean_30d_same_hour IS NULL"),
]


@query(
    "quality_gold",
    with_frames(
        _checks_sql("gold", "series_id", _GOLD_CHECKS)
        + "\nUNION ALL SELECT dt, series_id, 'required_columns', 'hard', CAST(0 AS BIGINT), true FROM f"
        + "\nUNION ALL SELECT dt, series_id, 'critical_columns', 'soft', CAST(0 AS BIGINT), true FROM f"
    ),
)
def quality_gold(f):
    """Gold with the rows that have no label yet."""
    return quality.check_gold(f.gold(mode="serve"))
