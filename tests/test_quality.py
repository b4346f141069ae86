import pytest
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.operators import quality
from loadlake.plans.silver import calendar_days


@pytest.fixture(scope="module")
def day(spark):
    return spark.sql(
        """SELECT ts AS event_ts_utc, to_date(ts) AS dt, 's' AS source, '410' AS filter_id, 'DE' AS region, 'hour' AS resolution,
                  CAST(hour(ts) AS DOUBLE) AS load_mw
           FROM (SELECT explode(sequence(timestamp'2024-01-01 00:00', timestamp'2024-01-01 23:00', interval 1 hour)) AS ts)"""
    )


def failing(checks):
    return {(r.check, r.violations) for r in checks.where("NOT passed").collect()}


def test_clean_day_passes(day):
    checks = quality.check_silver_demand(day, "2024-01-01")
    assert failing(checks) == set()
    quality.enforce(checks, strict=True)


def test_each_fault_is_found(day):
    assert failing(quality.check_silver_demand(day.unionByName(day.limit(1)))) == {("unique_event_ts_utc", 1), ("rows_24", 1)}
    assert failing(quality.check_silver_demand(day.where("hour(event_ts_utc) <> 5"))) == {("rows_24", 1)}
    negative = day.withColumn("load_mw", F.when(F.hour("event_ts_utc") < 2, -1.0).otherwise(F.col("load_mw")))
    assert failing(quality.check_silver_demand(negative)) == {("load_mw_not_negative", 2)}
    gap = day.withColumn("load_mw", F.when(F.hour("event_ts_utc") > 2, F.col("load_mw")))
    assert failing(quality.check_silver_demand(gap)) == {("load_mw_not_null", 3)}
    untimed = day.withColumn("event_ts_utc", F.when(F.hour("event_ts_utc") > 0, F.col("event_ts_utc")))
    assert failing(quality.check_silver_demand(untimed, "2024-01-01")) == {("event_ts_utc_not_null", 1), ("unique_event_ts_utc", 1)}
    assert failing(quality.check_silver_demand(day, "2024-01-02")) == {("dt_matches", 24)}
    assert failing(quality.check_silver_demand(day.drop("resolution"))) == {("required_columns", 1)}


def test_series_of_one_region_are_checked_apart(day):
    """Two filters of a region are two series of 24 rows; a fault is reported for the one that has it."""
    second = day.withColumn("filter_id", F.lit("411"))
    assert failing(quality.check_silver_demand(day.unionByName(second))) == set()
    faulty = quality.check_silver_demand(day.unionByName(second).unionByName(second.limit(2))).where("NOT passed")
    assert {(r.filter_id, r.check, r.violations) for r in faulty.collect()} == {("411", "unique_event_ts_utc", 2), ("411", "rows_24", 2)}


def test_empty_partition_fails(spark, day):
    expected = spark.sql("SELECT date'2024-01-01' AS dt, 'DE' AS region UNION ALL SELECT date'2024-01-02', 'DE'")
    assert failing(quality.check_silver_demand(day, expected=expected)) == {("present", 1), ("rows_24", 24)}
    other = day.withColumn("region", F.lit("AT")).limit(3)
    assert ("rows_24", 21) in failing(quality.check_silver_demand(day.unionByName(other), expected=expected))
    verdicts = {str(r.dt): r.verdict for r in quality.day_verdicts(quality.check_silver_demand(day, expected=expected), False).collect()}
    assert verdicts == {"2024-01-01": "pass", "2024-01-02": "fail"}


def test_gate_tells_hard_from_soft(day):
    soft = quality.check_silver_demand(day.where("hour(event_ts_utc) <> 5"))
    quality.enforce(soft, strict=False)
    with pytest.raises(quality.DataQualityError, match="rows_24"):
        quality.enforce(soft, strict=True)
    hard = quality.check_silver_demand(day.unionByName(day))
    with pytest.raises(quality.DataQualityError, match="unique_event_ts_utc"):
        quality.enforce(hard, strict=False)


def test_weather_and_calendar(spark, day):
    weather = day.select("event_ts_utc", "dt", F.lit("berlin").alias("location_name"), *[F.lit(1.0).alias(v) for v in schemas.WEATHER_VARIABLES])
    assert failing(quality.check_silver_weather(weather)) == set()
    assert failing(quality.check_silver_weather(weather.withColumn("precipitation", F.lit(None).cast("double")))) == {("precipitation_not_null", 24)}
    calendar = calendar_days(spark, "2024-01-01", "2024-01-03")
    assert failing(quality.check_silver_calendar(calendar)) == set()
    assert failing(quality.check_silver_calendar(calendar.where("dt = '2024-01-01'"), "2024-01-02")) == {("dt_matches", 1)}


def test_gold_is_unique_per_series(day):
    gold = day.select("event_ts_utc", "dt", "load_mw", F.col("load_mw").alias("target_load_mw"), F.lit(1.0).alias("load_lag_7d"))
    both = gold.withColumn("series_id", F.lit("a")).unionByName(gold.withColumn("series_id", F.lit("b")))
    checks = quality.check_gold(both)
    assert failing(checks) == {("critical_columns", 1)}
    assert checks.where("check = 'critical_columns'").first().severity == "soft"
    assert {r.series_id for r in checks.select("series_id").distinct().collect()} == {"a", "b"}
    assert ("series_id_not_null", 24) in failing(quality.check_gold(gold.withColumn("series_id", F.lit(None).cast("string"))))
