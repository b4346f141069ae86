from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlake.functions.timefns import DAY, HOUR
from loadlake.operators import blocks, grid, history, samples
from loadlake.plans.gold import day_ahead_features
from loadlake.plans.silver import calendar_days


def long_demand(spark, days=800):
    """Two gap-free series with some NULL loads, long enough for several blocks."""
    first = F.to_timestamp(F.lit("2022-01-01"))
    series = spark.createDataFrame([("a",), ("b",)], "series_id STRING")
    hours = grid.grid(series, first, first + F.make_dt_interval(F.lit(days)) - F.expr(grid.STEP))
    load = F.pmod(F.hash("series_id", "event_ts_utc"), F.lit(10_000)) / 7.0
    return hours.select(
        "series_id",
        "event_ts_utc",
        F.to_date("event_ts_utc").alias("dt"),
        F.when(F.pmod(F.hash("event_ts_utc", "series_id"), F.lit(29)) != 0, load).alias("load_mw"),
    )


def differences(left, right):
    return left.exceptAll(right).count() + right.exceptAll(left).count()


@pytest.mark.parametrize("frame", ["days", "reference"])
def test_blocked_windows_equal_whole_series_windows(spark, frame):
    demand = long_demand(spark).withColumn("hour", F.hour("event_ts_utc"))
    in_time = Window.partitionBy("series_id").orderBy("event_ts_utc")
    by_hour = Window.partitionBy("series_id", "hour").orderBy(F.unix_seconds("event_ts_utc"))
    lags = {name: F.lag("load_mw", n).over(in_time) for name, n in history.LOAD_LAGS.items()}
    plain = demand.withColumns(lags).withColumn(
        "target_load_mw", F.lead("load_mw", 24).over(in_time)
    )
    plain = plain.withColumns(history.same_hour_columns(by_hour, frame))
    stats = [c for c in plain.columns if "same_hour" in c]
    blocked = history.load_history(demand, frame)
    cols = [*[c for c in plain.columns if c not in stats], *[F.round(c, 6).alias(c) for c in stats]]
    assert differences(blocked.select(cols), plain.select(cols)) == 0


def test_blocks_bound_a_window(spark):
    demand = long_demand(spark)
    blocked = blocks.with_blocks(demand, "event_ts_utc", 120 * DAY, 30 * DAY, DAY)
    sizes = blocked.groupBy("series_id", blocks.BLOCK).count().agg(F.max("count")).first()[0]
    assert sizes <= (120 + 30 + 1) * 24
    assert blocked.where(blocks.OWN).count() == demand.count()
    assert blocked.count() < 1.4 * demand.count()


def test_lead_is_the_load_a_day_later(spark):
    demand = long_demand(spark, 60)
    led = history.load_history(demand.withColumn("hour", F.hour("event_ts_utc")))
    moved = led.select("series_id", (F.col("event_ts_utc") + F.expr("INTERVAL 24 HOURS")).alias("ts"), "target_load_mw")
    later = demand.where(F.col("dt") > date(2022, 1, 1)).select("series_id", F.col("event_ts_utc").alias("ts"), "load_mw")
    inside = moved.where(F.col("ts") < F.lit("2022-03-02").cast("timestamp"))
    assert differences(inside, later) == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 71), st.integers(0, 99)), min_size=1, max_size=30))
def test_filled_grid_has_24_rows_a_day(spark, points):
    df = spark.createDataFrame([(s, h, float(v)) for s, h, v in points], "series_id STRING, h INT, load_mw DOUBLE").select(
        "series_id", F.expr("timestamp'2024-03-30' + make_dt_interval(0, h)").alias("event_ts_utc"), "load_mw"
    )
    first, last = grid.day_span("2024-03-30", "2024-04-01")
    filled = grid.fill_grid(df, ["series_id"], first, last)
    per_day = filled.groupBy("series_id", F.to_date("event_ts_utc")).count().collect()
    assert len(per_day) == 3 * len({s for s, _, _ in points})
    assert {r["count"] for r in per_day} == {24}
    largest = {}
    for s, h, v in points:
        largest[s, h] = max(v, largest.get((s, h), 0))
    got = {(r.series_id, int((r.event_ts_utc - r.event_ts_utc.replace(day=30, month=3, hour=0)).total_seconds() // 3600)): r.load_mw
           for r in filled.where("load_mw IS NOT NULL").collect()}
    assert got == {k: float(v) for k, v in largest.items()}


def test_numbered_over_many_blocks(spark):
    demand = long_demand(spark).where(F.col("load_mw").isNotNull())
    w = Window.partitionBy("series_id").orderBy("event_ts_utc")
    plain = demand.select("series_id", "event_ts_utc", (F.row_number().over(w) - 1).cast("bigint").alias("time_idx"))
    got = samples.time_index(demand).select("series_id", "event_ts_utc", F.col("time_idx").cast("bigint").alias("time_idx"))
    assert differences(got, plain) == 0


def test_samples_hold_nothing_newer_than_their_origin(spark):
    demand = long_demand(spark, 40).withColumn("hour", F.hour("event_ts_utc"))
    gold = history.load_history(demand)
    windows = samples.sequence_samples(gold, ["load_mw"])
    assert windows.count() == gold.where("dt >= '2022-01-08' AND target_load_mw IS NOT NULL").count()
    newest_feature = F.array_max("encoder.event_ts_utc")
    newest_label = F.array_max("label_history.event_ts_utc")
    bad = windows.where(
        (newest_feature >= F.col("event_ts_utc"))
        | (F.unix_seconds(newest_label) + 24 * HOUR > F.unix_seconds("event_ts_utc"))
        | (F.size("encoder") != 168)
        | (F.size("label_history") != 145)
    )
    assert bad.isEmpty()


def test_a_range_of_days_equals_the_union_of_day_runs(spark):
    demand = long_demand(spark, 50)
    weather = demand.where("series_id = 'a'").select(
        "event_ts_utc", "dt", F.lit("berlin").alias("location_name"), (F.col("load_mw") / 40).alias("temperature_2m")
    )
    days = [date(2022, 2, 7) + timedelta(days=i) for i in range(4)]
    calendar = calendar_days(spark, "2022-01-01", "2022-03-01")
    whole = day_ahead_features(demand, weather, calendar, days[0], days[-1])
    runs = None
    for day in days:
        one = day_ahead_features(demand, weather, calendar, day, day)
        runs = one if runs is None else runs.unionByName(one)
    assert whole.count() > 0
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in whole.dtypes]
    assert differences(whole.select(cols), runs.select(cols)) == 0


def test_serving_keeps_days_without_a_label(spark):
    demand = long_demand(spark, 40)
    weather = demand.where("series_id = 'a'").select("event_ts_utc", "dt", F.lit(20.0).alias("temperature_2m"))
    calendar = calendar_days(spark, "2022-01-01", "2022-03-01")
    last = date(2022, 2, 9)
    assert day_ahead_features(demand, weather, calendar, last, last).isEmpty()
    assert day_ahead_features(demand, weather, calendar, last, last, mode="serve").count() == 48


def test_several_locations_do_not_multiply_rows(spark):
    demand = long_demand(spark, 20)
    places = spark.createDataFrame([("x", 10.0), ("y", 20.0)], "location_name STRING, temperature_2m DOUBLE")
    weather = demand.where("series_id = 'a'").select("event_ts_utc", "dt").join(F.broadcast(places))
    calendar = calendar_days(spark, "2022-01-01", "2022-03-01")
    mean = day_ahead_features(demand, weather, calendar, mode="serve")
    assert mean.count() == demand.count()
    assert mean.select("temperature_2m").distinct().collect()[0][0] == 15
    placed = demand.withColumn("location_name", F.when(F.col("series_id") == "a", "x").otherwise("y"))
    own = day_ahead_features(placed, weather, calendar, mode="serve")
    assert {(r.series_id, r.temperature_2m) for r in own.select("series_id", "temperature_2m").distinct().collect()} == {("a", 10.0), ("b", 20.0)}


def test_missing_weather_gives_zero_degrees(spark):
    demand = long_demand(spark, 5)
    weather = demand.where("series_id = 'a'").select("event_ts_utc", "dt", F.lit(10.0).alias("temperature_2m")).where("dt < '2022-01-03'")
    gold = day_ahead_features(demand, weather, calendar_days(spark, "2022-01-01", "2022-01-05"), mode="serve")
    row = gold.where("dt = '2022-01-04'").first()
    assert (row.temperature_2m, row.heating_degree, row.cooling_degree) == (None, 0.0, 0.0)


def test_demand_without_a_series_column_gets_the_default(spark):
    demand = long_demand(spark, 3).where("series_id = 'a'").drop("series_id")
    weather = demand.select("event_ts_utc", "dt", F.lit(1.0).alias("cloud_cover"))
    gold = day_ahead_features(demand, weather, calendar_days(spark, "2022-01-01", "2022-01-03"), mode="serve")
    assert [r.series_id for r in gold.select("series_id").distinct().collect()] == ["DE"]
    assert "temp_lag_24h" not in gold.columns


def test_lags_go_by_time_over_gaps_and_doubled_hours(spark):
    demand = long_demand(spark, 60)
    day = F.lit("2022-01-20").cast("date")
    holed = demand.where(F.col("dt") != day).unionByName(demand.where(F.hour("event_ts_utc") == 5))
    got = history.load_lags(holed).select("series_id", "event_ts_utc", "load_lag_24h")
    ago = holed.groupBy("series_id", (F.col("event_ts_utc") + F.expr("INTERVAL 24 HOURS")).alias("event_ts_utc")).agg(F.max("load_mw").alias("load_lag_24h"))
    want = holed.select("series_id", "event_ts_utc").join(ago, ["series_id", "event_ts_utc"], "left")
    assert differences(got, want) == 0
    assert got.where((F.to_date("event_ts_utc") == F.date_add(day, 1)) & F.col("load_lag_24h").isNotNull()).where(F.hour("event_ts_utc") != 5).count() == 0
