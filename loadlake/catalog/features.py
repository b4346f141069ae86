"""Joins, windows, gold features and point-in-time lookups."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlake.catalog.frames import GOLD_COLUMNS, GOLD_ROUNDED, rounded, with_frames
from loadlake.catalog.registry import query
from loadlake.functions.timefns import DAY, HOUR
from loadlake.operators import history, samples
from loadlake.operators.asof import asof_join, latest
from loadlake.operators.bitemporal import known_asof_join
from loadlake.plans.gold import day_ahead_features, joined_base
from loadlake.session import shared_dir
from loadlake.sources import tables

_KEYS = ("event_ts_utc", "dt", "series_id", "load_mw")
_LAGS = tuple(history.LOAD_LAGS)
SAME_HOUR_STATS = ("load_mean_7d_same_hour", "load_mean_30d_same_hour", "load_std_30d_same_hour")


@query("joined_base", with_frames("SELECT * FROM base"))
def joined_base_query(f):
    weather = f.weather
    return joined_base(f.demand, weather, f.calendar)


@query("load_lags", with_frames(f"SELECT {', '.join(_KEYS + _LAGS)} FROM gold"))
def load_lags(f):
    return history.load_lags(f.demand)


@query("same_hour_stats_days", with_frames(f"SELECT {', '.join(_KEYS)}, hour, {', '.join(SAME_HOUR_STATS)} FROM gold"))
def same_hour_stats_days(f):
    return rounded(history.same_hour_stats(f.demand), *SAME_HOUR_STATS)


@query(
    "same_hour_stats_reference",
    with_frames(f"""SELECT {', '.join(_KEYS)}, hour,
        round(avg(load_mw) OVER (h ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS load_mean_7d_same_hour,
        round(avg(load_mw) OVER (h ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING), 6) AS load_mean_30d_same_hour,
        round(stddev_samp(load_mw) OVER (h ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING), 6) AS load_std_30d_same_hour
      FROM base WINDOW h AS (PARTITION BY series_id, hour ORDER BY event_ts_utc)"""),
)
def same_hour_stats_reference(f):
    return rounded(history.same_hour_stats(f.demand, "reference"), *SAME_HOUR_STATS)


@query(
    "weather_features",
    with_frames("""SELECT event_ts_utc, temperature_2m,
        lag(temperature_2m, 24) OVER w AS temp_lag_24h,
        round(avg(temperature_2m) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS temp_mean_7d,
        CASE WHEN temperature_2m < 18 THEN 18 - temperature_2m ELSE 0.0 END AS heating_degree,
        CASE WHEN temperature_2m > 22 THEN temperature_2m - 22 ELSE 0.0 END AS cooling_degree
      FROM hours LEFT JOIN weather USING (event_ts_utc) WINDOW w AS (ORDER BY event_ts_utc)"""),
)
def weather_features(f):
    wide = history.weather_history(f.weather_filled)
    columns = ("event_ts_utc", "temperature_2m", "temp_lag_24h", "temp_mean_7d", "heating_degree", "cooling_degree")
    return rounded(wide, "temp_mean_7d").select(*columns)


@query("gold_features_train", with_frames(f"SELECT {', '.join(GOLD_COLUMNS)} FROM gold_train"))
def gold_features_train(f):
    return rounded(f.gold(), *GOLD_ROUNDED).select(*GOLD_COLUMNS)


@query("gold_features_serve", with_frames(f"SELECT {', '.join(GOLD_COLUMNS)} FROM gold"))
def gold_features_serve(f):
    return rounded(f.gold(mode="serve"), *GOLD_ROUNDED).select(*GOLD_COLUMNS)


@query(
    "gold_features_reference",
    with_frames("""SELECT event_ts_utc, series_id, load_lag_14d, target_load_mw,
        round(avg(load_mw) OVER (h ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS load_mean_7d_same_hour,
        round(avg(load_mw) OVER (h ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING), 6) AS load_mean_30d_same_hour,
        round(stddev_samp(load_mw) OVER (h ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING), 6) AS load_std_30d_same_hour
      FROM gold WINDOW h AS (PARTITION BY series_id, hour ORDER BY event_ts_utc)
      QUALIFY target_load_mw IS NOT NULL AND load_lag_24h IS NOT NULL"""),
)
def gold_features_reference(f):
    gold = f.gold(frame="reference")
    return rounded(gold, *SAME_HOUR_STATS).select("event_ts_utc", "series_id", "load_lag_14d", "target_load_mw", *SAME_HOUR_STATS)


@query("gold_range", with_frames(f"SELECT {', '.join(GOLD_COLUMNS)} FROM gold_train"))
def gold_range(f):
    """Gold of every day from one plan, stored by day."""
    root = shared_dir(f.spark, "gold")
    tables.write_days(f.gold(), root)
    return rounded(tables.read_days(f.spark, root), *GOLD_ROUNDED).select(*GOLD_COLUMNS)


@query(
    "time_index",
    with_frames("""SELECT series_id, event_ts_utc, load_mw,
        row_number() OVER (PARTITION BY series_id ORDER BY event_ts_utc) - 1 AS time_idx FROM actuals"""),
)
def time_index(f):
    indexed = samples.time_index(f.actuals)
    return indexed.select("series_id", "event_ts_utc", "load_mw", "time_idx")


@query(
    "scored_alignment",
    with_frames(""", indexed AS (
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY event_ts_utc) - 1 AS time_idx FROM gold_train)
      SELECT series_id, time_idx, event_ts_utc, target_load_mw, load_lag_24h AS prediction FROM indexed"""),
)
def scored_alignment(f):
    """Predictions that carry only (series_id, time_idx) meet their labels by key."""
    indexed = tables.stored(samples.time_index(f.gold()), "indexed")
    predictions = indexed.select("series_id", "time_idx", F.col("load_lag_24h").alias("prediction"))
    labels = indexed.select("series_id", "time_idx", "event_ts_utc", "target_load_mw")
    return labels.join(predictions, ["series_id", "time_idx"])


@query(
    "sequence_samples",
    with_frames(""", s AS (
        SELECT series_id, event_ts_utc, target_load_mw AS label, load_mw,
          count(*) OVER enc AS encoder_rows, min(event_ts_utc) OVER enc AS encoder_start, max(event_ts_utc) OVER enc AS encoder_end,
          round(sum(coalesce(load_mw, 0)) OVER enc, 4) AS encoder_load,
          count(*) OVER lab AS label_rows, max(event_ts_utc) OVER lab AS label_end, round(sum(coalesce(target_load_mw, 0)) OVER lab, 4) AS label_sum
        FROM gold
        WINDOW enc AS (PARTITION BY series_id ORDER BY event_ts_utc RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING),
               lab AS (PARTITION BY series_id ORDER BY event_ts_utc RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 24 HOUR PRECEDING))
      SELECT series_id, event_ts_utc, label, load_mw AS decoder_load, encoder_rows, encoder_start, encoder_end, encoder_load,
        label_rows, label_end, label_sum FROM s WHERE encoder_rows = 168 AND label IS NOT NULL"""),
)
def sequence_samples(f):
    """Every sample, described by the ends and sums of its sequences."""
    windows = samples.sequence_samples(f.gold(mode="serve"), ["load_mw", "temperature_2m", "hour"])

    def total(column: str, field: str):
        return F.round(F.aggregate(column, F.lit(0.0), lambda a, x: a + F.coalesce(x[field], F.lit(0.0))), 4)

    return windows.select(
        "series_id",
        "event_ts_utc",
        "label",
        F.col("decoder.load_mw").alias("decoder_load"),
        F.size("encoder").cast("bigint").alias("encoder_rows"),
        F.array_min("encoder.event_ts_utc").alias("encoder_start"),
        F.array_max("encoder.event_ts_utc").alias("encoder_end"),
        total("encoder", "load_mw").alias("encoder_load"),
        F.size("label_history").cast("bigint").alias("label_rows"),
        F.array_max("label_history.event_ts_utc").alias("label_end"),
        total("label_history", "label").alias("label_sum"),
    )


@query(
    "point_in_time_features",
    with_frames("""SELECT e.event_id, e.event_type AS series_id, e.ts, g.event_ts_utc AS feature_ts, g.load_mw, g.load_lag_24h
      FROM events e ASOF LEFT JOIN gold g ON e.event_type = g.series_id AND e.ts >= g.event_ts_utc"""),
)
def point_in_time_features(f):
    spine = f.events.select("event_id", F.col("event_type").alias("series_id"), "ts")
    gold = f.gold(mode="serve").select(
        "series_id", F.col("event_ts_utc").alias("feature_ts"), "load_mw", "load_lag_24h"
    )
    return asof_join(spine, gold, ["series_id"], "ts", "feature_ts", ttl_seconds=30 * DAY, block_seconds=HOUR)


@query(
    "point_in_time_strict_ttl",
    with_frames(""", known AS (SELECT series_id, event_ts_utc, load_mw FROM demand WHERE load_mw IS NOT NULL)
      SELECT d.series_id, d.event_ts_utc,
        CASE WHEN d.event_ts_utc - k.event_ts_utc <= INTERVAL 1 HOUR THEN k.event_ts_utc END AS feature_ts,
        CASE WHEN d.event_ts_utc - k.event_ts_utc <= INTERVAL 1 HOUR THEN k.load_mw END AS known_load
      FROM demand d ASOF LEFT JOIN known k ON d.series_id = k.series_id AND d.event_ts_utc > k.event_ts_utc"""),
)
def point_in_time_strict_ttl(f):
    """Only what was known before the hour, and no older than an hour."""
    demand = f.demand
    known = demand.where(F.col("load_mw").isNotNull()).select(
        "series_id", F.col("event_ts_utc").alias("feature_ts"), F.col("load_mw").alias("known_load")
    )
    return asof_join(
        demand.select("series_id", "event_ts_utc"), known, ["series_id"], "event_ts_utc", "feature_ts", HOUR, strict=True
    )


@query(
    "latest_features",
    with_frames("""SELECT series_id, event_ts_utc, load_mw, load_lag_24h, load_lag_7d FROM gold WHERE load_mw IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY event_ts_utc DESC) = 1"""),
)
def latest_features(f):
    gold = f.gold(mode="serve").where(F.col("load_mw").isNotNull())
    return latest(
        gold.select("series_id", "event_ts_utc", "load_mw", "load_lag_24h", "load_lag_7d"), ["series_id"], "event_ts_utc"
    )


_CONTRACT_SQL = ", ".join(
    f"CAST({name} AS {'FLOAT' if kind == 'float' else 'INT'}) AS {name}"
    for name, kind in samples.schemas.FEATURE_CONTRACT.items()
)


@query("feature_contract", with_frames(f"SELECT series_id, event_ts_utc, {_CONTRACT_SQL} FROM gold_train"))
def feature_contract(f):
    return samples.feature_contract(rounded(f.gold(), *GOLD_ROUNDED))


_GAPS_SQL = """, gaps AS (
    SELECT event_ts_utc, dt, series_id, load_mw FROM demand, run
    WHERE NOT (series_id = (SELECT min(event_type) FROM events) AND dt = d - 2)
    UNION ALL
    SELECT event_ts_utc, dt, series_id, load_mw + 1 FROM demand, run
    WHERE series_id = (SELECT max(event_type) FROM events) AND dt = d - 1 AND hour(event_ts_utc) = 10
  ), at_hour AS (SELECT series_id, event_ts_utc, max(load_mw) AS load_mw FROM gaps GROUP BY ALL)"""


def _at(name: str, hours: int) -> str:
    shift = f"g.event_ts_utc + INTERVAL ({hours}) HOUR"
    return f"(SELECT load_mw FROM at_hour h WHERE h.series_id = g.series_id AND h.event_ts_utc = {shift}) AS {name}"


@query(
    "gold_features_gaps",
    with_frames(
        f"""{_GAPS_SQL}
      SELECT g.event_ts_utc, g.dt, g.series_id, g.load_mw, {", ".join(_at(n, -h) for n, h in history.LOAD_LAGS.items())},
        {_at("target_load_mw", 24)},
        (SELECT round(avg(b.load_mw), 6) FROM gaps b WHERE b.series_id = g.series_id AND hour(b.event_ts_utc) = hour(g.event_ts_utc)
           AND b.event_ts_utc < g.event_ts_utc AND b.event_ts_utc >= g.event_ts_utc - INTERVAL 7 DAY) AS load_mean_7d_same_hour
      FROM gaps g, run WHERE g.dt >= d - 3"""
    ),
)
def gold_features_gaps(f):
    """A series without a whole day, and another with an hour that came twice: lags and labels go by time."""
    weather = f.weather_filled
    low, high = f.hourly.agg(F.min("series_id"), F.max("series_id")).first()
    day = F.col("dt")
    gone = (F.col("series_id") == low) & (day == F.lit(f.run_day - timedelta(days=2)))
    again = (F.col("series_id") == high) & (day == F.lit(f.run_day - timedelta(days=1))) & (F.hour("event_ts_utc") == 10)
    faulty = f.demand.where(~gone).unionByName(f.demand.where(again).withColumn("load_mw", F.col("load_mw") + 1))
    gold = day_ahead_features(faulty, weather, f.calendar, f.run_day - timedelta(days=3), mode="serve")
    return rounded(gold.select(*_KEYS, *_LAGS, "target_load_mw", "load_mean_7d_same_hour"), "load_mean_7d_same_hour")


@query(
    "gold_located",
    with_frames("""
      SELECT 'events/' || filter_id || '/' || series_id || '/hour' AS series_id, location_name, event_ts_utc,
        load_mw + more AS load_mw, load_lag_1h + more AS load_lag_1h, load_lag_24h + more AS load_lag_24h,
        temperature_2m + warmer AS temperature_2m, temp_lag_24h + warmer AS temp_lag_24h
      FROM gold, run, (VALUES ('f1', 'site0', 0, 0), ('f2', 'site1', 1000, 1)) v(filter_id, location_name, more, warmer)
      WHERE dt >= d - 3"""),
)
def gold_located(f):
    """Two locations, two filters of each region, and weather that landed twice: still one row per series and hour."""
    weather = f.weather_filled
    sites = weather.unionByName(
        weather.withColumns({"location_name": F.lit("site1"), "temperature_2m": F.col("temperature_2m") + 1})
    )
    whole = f.demand.select(
        "event_ts_utc", "dt", F.lit("events").alias("source"), F.col("series_id").alias("region"), F.lit("hour").alias("resolution"),
        F.inline(F.array(
            F.struct(F.lit("f1").alias("filter_id"), F.lit("site0").alias("location_name"), F.col("load_mw").alias("load_mw")),
            F.struct(F.lit("f2").alias("filter_id"), F.lit("site1").alias("location_name"), (F.col("load_mw") + 1000).alias("load_mw")),
        )),
    )
    gold = day_ahead_features(whole, sites.unionByName(sites), f.calendar, f.run_day - timedelta(days=3), mode="serve")
    return gold.select(
        "series_id", "location_name", "event_ts_utc", "load_mw", "load_lag_1h", "load_lag_24h", "temperature_2m", "temp_lag_24h"
    )


#: One event in ten lands a day late, and one in five is corrected six hours after it was known.
_LANDED_SQL = """WITH first AS (
    SELECT event_type AS series_id, ts AS value_ts, value, event_id,
      ts + (CASE WHEN event_id * 7919 % 10 = 3 THEN 1560 ELSE 2 + event_id % 13 END) * INTERVAL 1 MINUTE AS known_ts
    FROM events),
  versions AS (
    SELECT series_id, value_ts, known_ts, value FROM first
    UNION ALL SELECT series_id, value_ts, known_ts + INTERVAL 6 HOUR, value + 1 FROM first WHERE event_id % 5 = 0),
  asked AS (SELECT event_id, event_type AS series_id, ts, ts + (event_id % 3) * INTERVAL 1 HOUR AS origin FROM events)"""


@query(
    "known_at_origin",
    f"""{_LANDED_SQL}
      SELECT a.event_id, a.series_id, a.ts, a.origin, best.e AS value_ts, best.k AS known_ts, best.v AS value
      FROM asked a LEFT JOIN (
        SELECT a.event_id, max({{'e': v.value_ts, 'k': v.known_ts, 'v': v.value}}) AS best
        FROM asked a JOIN versions v ON v.series_id = a.series_id AND v.value_ts <= a.ts AND v.known_ts <= a.origin
        GROUP BY a.event_id) USING (event_id)""",
)
def known_at_origin(f):
    """The newest value at each event's time as it was known up to two hours later, with values that land late or are corrected."""
    id, ts = F.col("event_id"), F.col("ts")
    delay = F.when(id * 7919 % 10 == 3, 1560).otherwise(2 + id % 13)
    first = f.events.select(
        F.col("event_type").alias("series_id"), ts.alias("value_ts"), _minutes_after(ts, delay).alias("known_ts"), "value", "event_id"
    )
    corrected = first.where(F.col("event_id") % 5 == 0).withColumns({"known_ts": _minutes_after(F.col("known_ts"), F.lit(360)), "value": F.col("value") + 1})
    asked = f.events.select("event_id", F.col("event_type").alias("series_id"), "ts", _minutes_after(ts, id % 3 * 60).alias("origin"))
    return known_asof_join(asked, first.unionByName(corrected).drop("event_id"), ["series_id"], "ts", "origin", "value_ts", "known_ts")


def _minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("long") * 60_000_000)
