from datetime import date

import pytest
from pyspark.sql import functions as F

from loadlake.plans import monitoring, policy

DAY = date(2024, 1, 20)


def metrics(spark, day, mape):
    return spark.sql(f"SELECT date'{day}' AS target_date, 's' AS series_id, {mape}D AS mape")


def drift(spark, day, psi, flag="false"):
    return spark.sql(f"SELECT date'{day}' AS eval_date, 'load_mw' AS feature, {psi}D AS psi, {flag} AS is_drift")


@pytest.mark.parametrize(
    "m,d,want",
    [
        (("2024-01-20", 6.1), None, True),
        (("2024-01-20", 6.0), None, False),
        (("2024-01-13", 9.0), None, True),
        (("2024-01-12", 9.0), None, False),
        (None, ("2024-01-15", 0.21), True),
        (None, ("2024-01-15", 0.2), False),
        (None, ("2024-01-15", 0.0, "true"), True),
        (("2024-01-20", 1.0), ("2024-01-05", 5.0), False),
    ],
)
def test_retrain_decision(spark, m, d, want):
    row = policy.retrain_decision(metrics(spark, *m) if m else None, drift(spark, *d) if d else None, DAY).collect()
    assert len(row) == 1 and row[0].retrain is want


def test_drift_windows(spark):
    """Recent is [D-7, D], baseline [D-35, D-8]; rows outside count nowhere."""
    gold = spark.sql("SELECT explode(sequence(date'2023-11-01', date'2024-02-01')) AS dt, 'a' AS series_id, 1.0D AS load_mw")
    row = monitoring.drift(gold, DAY).first()
    assert (row.n_recent, row.n_baseline, row.feature) == (8, 28, "load_mw")
    assert monitoring.drift(gold.where("dt >= '2024-01-13'"), DAY).isEmpty()


def test_volume_anomaly(spark):
    days = spark.sql("SELECT 'k' AS k, dt, explode(sequence(1, CASE WHEN dt = '2024-01-15' THEN 90 WHEN dayofmonth(dt) % 2 = 0 THEN 10 ELSE 11 END)) AS i"
                     " FROM (SELECT explode(sequence(date'2024-01-01', date'2024-01-20')) AS dt) WHERE dt <> '2024-01-18'")
    counts = monitoring.daily_volume(days, ["k"], "dt")
    volume = monitoring.fill_days(counts, ["k"], F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 20)))
    assert volume.count() == 20
    rows = {r.dt.day: r for r in monitoring.volume_anomaly(volume, ["k"]).collect()}
    assert rows[15].is_anomaly and not rows[14].is_anomaly and not rows[1].is_anomaly
    assert rows[18].n_rows == 0


def test_alerts_and_freshness(spark):
    events = spark.sql("SELECT 'a' AS source, timestamp'2024-01-01 00:00' AS ts UNION ALL SELECT 'b', timestamp'2024-01-01 00:59'")
    now = F.lit("2024-01-01 01:00").cast("timestamp")
    fresh = monitoring.freshness(events, "source", "ts", now, 120)
    assert {r.source: (r.age_seconds, r.is_fresh) for r in fresh.collect()} == {"a": (3600, False), "b": (60, True)}
    readings = policy.readings(fresh, "age", F.col("source"), F.to_date("last_ts"), F.col("age_seconds"), 120)
    assert [r.subject for r in policy.alert_rows([readings, readings.where("false")]).collect()] == ["a"]


def test_successful_runs(spark):
    runs = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-01-10', interval 1 day)) AS created_at, 'success' AS status")
    row = monitoring.successful_runs(runs, F.lit("2024-01-10").cast("timestamp")).first()
    assert (row.n_success, row.is_green) == (7, True)
