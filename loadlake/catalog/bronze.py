"""Landing, silver and table round trips."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.catalog.frames import Frames, day_bounds, with_frames
from loadlake.catalog.registry import query
from loadlake.functions import timefns
from loadlake.functions.timefns import hours_in_local_day, local_day, to_millis
from loadlake.operators.grid import hourly_rollup
from loadlake.plans import silver
from loadlake.plans.monitoring import actuals
from loadlake.session import shared_dir
from loadlake.sources import bronze, tables


def _event_points(f: Frames) -> DataFrame:
    return f.events.select(
        F.lit("events").alias("source"),
        F.lit("410").alias("filter_id"),
        F.col("event_type").alias("region"),
        F.lit("hour").alias("resolution"),
        F.col("ts").alias("event_ts_utc"),
        F.col("value").alias("load_mw"),
    )


def _landed_demand(f: Frames) -> DataFrame:
    root = shared_dir(f.spark, "bronze-demand")
    bronze.write_documents(bronze.demand_documents(_event_points(f)), root)
    return bronze.read_demand(f.spark, root)


def _landed_weather(f: Frames) -> DataFrame:
    """Weather documents; those of the 15th of a month lack the last pressure value."""
    root = shared_dir(f.spark, "bronze-weather")
    pressure = F.col("raw.hourly.surface_pressure")
    cut = F.when(F.dayofmonth("ingestion_date") == 15, F.slice(pressure, 1, F.size(pressure) - 1)).otherwise(pressure)
    documents = bronze.weather_documents(f.weather).withColumn(
        "raw", F.struct(F.col("raw.hourly").withField("surface_pressure", cut).alias("hourly"))
    )
    bronze.write_documents(documents, root, ("location", "ingestion_date"))
    return bronze.read_weather(f.spark, root)


@query(
    "bronze_demand_points",
    """SELECT event_type AS region, date_trunc('millisecond', ts) AS event_ts_utc, CAST(ts AS DATE) AS dt, value AS load_mw
       FROM events""",
)
def bronze_demand_points(f):
    points = bronze.demand_points(_landed_demand(f))
    return points.select("region", "event_ts_utc", "dt", "load_mw")


@query(
    "bronze_points_fallback",
    "SELECT event_type AS series_id, epoch_us(ts) // 1000 AS ts_ms, value AS load_mw FROM events",
)
def bronze_points_fallback(f):
    """Raw chunks with the list under each of the three keys, and a pair too short to use."""
    documents = bronze.demand_documents(_event_points(f))
    region = F.col("metadata.region")
    key = F.when(region.isin("click", "view"), "series").when(region == "error", "data").otherwise("values")
    pairs = F.transform(
        "data",
        lambda p: F.concat(F.lit("["), p["ts_ms"], F.lit(","), F.coalesce(p["load_mw"].cast("string"), F.lit("null")), F.lit("]")),
    )
    text = F.concat(F.lit('{"meta": {"version": 1}, "'), key, F.lit('": ['), F.array_join(pairs, ","), F.lit(",[0]]}"))
    chunks = documents.select(region.alias("series_id"), text.alias("text"))
    return bronze.chunk_points(chunks, "text", ["series_id"])


@query(
    "chunk_pick",
    """WITH idx AS (SELECT DISTINCT event_type, date_trunc('week', ts) + INTERVAL 3 DAY AS c FROM events),
       days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS dt FROM events)
       SELECT d.event_type AS series_id, d.dt,
         coalesce(max(epoch_ms(c)) FILTER (WHERE c <= d.dt), min(epoch_ms(c))) AS chunk_ts_ms
       FROM days d JOIN idx i ON i.event_type = d.event_type GROUP BY d.event_type, d.dt""",
)
def chunk_pick(f):
    """Weekly chunks that start on Thursdays, listed in both shapes of index file."""
    days = f.events.select(F.col("event_type").alias("series_id"), F.to_date("ts").alias("dt")).distinct()
    days = tables.stored(days, "days")
    start = F.unix_millis(F.date_trunc("week", "dt") + F.expr("INTERVAL 3 DAYS"))
    starts = days.select("series_id", start.alias("c")).distinct()
    listed = F.to_json(F.array_sort(F.collect_list("c")))
    text = F.when(F.col("series_id").isin("click", "view"), listed).otherwise(
        F.concat(F.lit('{"timestamps": '), listed, F.lit("}"))
    )
    indexes = starts.groupBy("series_id").agg(text.alias("text"))
    index = bronze.index_points(indexes, "text", ["series_id"])
    return bronze.pick_chunks(index, days, ["series_id"])


@query(
    "landed_chunks",
    with_frames("""SELECT series_id, event_ts_utc, dt, load_mw FROM demand"""),
)
def landed_chunks(f):
    """The whole landing of demand: weekly chunks, the chunk of each day, its envelope, and the points read back."""
    week = F.date_trunc("week", "event_ts_utc")
    pair = F.concat(
        F.lit("["), F.unix_millis("event_ts_utc"), F.lit(","), F.coalesce(F.col("load_mw").cast("string"), F.lit("null")), F.lit("]")
    )
    chunks = (
        f.demand.groupBy("series_id", F.unix_millis(week).alias("chunk_ts_ms"))
        .agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("pairs"))
        .select("series_id", "chunk_ts_ms", F.concat(F.lit('{"series": ['), "pairs", F.lit("]}")).alias("text"))
    )
    chunks = tables.stored(chunks, "chunks")
    days = f.demand.select("series_id", "dt").distinct()
    picked = bronze.pick_chunks(chunks.select("series_id", "chunk_ts_ms"), days, ["series_id"])
    named = picked.join(chunks, ["series_id", "chunk_ts_ms"]).select(
        F.lit("events").alias("source"),
        F.lit("410").alias("filter_id"),
        F.col("series_id").alias("region"),
        F.lit("hour").alias("resolution"),
        "chunk_ts_ms",
        "dt",
        "text",
    )
    root = shared_dir(f.spark, "bronze-chunks")
    bronze.write_documents(bronze.chunk_envelopes(named, "text", "dt", F.lit("2024-02-01").cast("timestamp")), root)
    points = bronze.demand_points(bronze.read_demand(f.spark, root))
    return points.select(F.col("region").alias("series_id"), "event_ts_utc", "dt", "load_mw")


_SHORT_PRESSURE = """CASE WHEN day(dt) = 15 AND event_ts_utc = max(event_ts_utc) OVER (PARTITION BY dt) THEN NULL
       ELSE surface_pressure END AS surface_pressure"""


@query(
    "bronze_weather_hourly",
    with_frames(f"SELECT * EXCLUDE (surface_pressure), {_SHORT_PRESSURE} FROM weather"),
)
def bronze_weather_hourly(f):
    return bronze.weather_hours(_landed_weather(f))


@query(
    "hourly_rollup",
    """SELECT event_type AS series_id, date_trunc('hour', ts) AS event_ts_utc, max(value) AS load_mw
       FROM events GROUP BY ALL""",
)
def hourly_rollup_query(f):
    points = f.events.select(
        F.col("event_type").alias("series_id"), F.col("ts").alias("event_ts_utc"), F.col("value").alias("load_mw")
    )
    return hourly_rollup(points, ["series_id"])


@query("hourly_grid_filled", with_frames("SELECT event_ts_utc, dt, series_id, load_mw FROM demand"))
def hourly_grid_filled(f):
    return f.demand


_WHOLE_DAYS = """full_days AS (
  SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS event_ts_utc
  FROM events
)"""


@query(
    "silver_demand",
    with_frames(f""", {_WHOLE_DAYS}
      SELECT g.event_ts_utc, CAST(g.event_ts_utc AS DATE) AS dt, 'events' AS source, '410' AS filter_id,
        s.event_type AS region, 'hour' AS resolution, d.load_mw
      FROM full_days g CROSS JOIN (SELECT DISTINCT event_type FROM events) s
      LEFT JOIN demand d ON d.event_ts_utc = g.event_ts_utc AND d.series_id = s.event_type"""),
)
def silver_demand_query(f):
    """All days in one plan, stored by day and read back."""
    first, last = day_bounds(f.events, "ts")
    root = shared_dir(f.spark, "silver-demand")
    tables.write_days(silver.silver_demand(_landed_demand(f), first, last), root)
    return tables.read_days(f.spark, root, columns=schemas.SILVER_DEMAND_REQUIRED)


@query(
    "silver_weather",
    with_frames(f""", {_WHOLE_DAYS}, w AS (SELECT * EXCLUDE (surface_pressure), {_SHORT_PRESSURE} FROM weather)
      SELECT g.event_ts_utc, CAST(g.event_ts_utc AS DATE) AS dt, 'site0' AS location_name,
        52.52::DOUBLE AS latitude, 13.405::DOUBLE AS longitude, {", ".join("w." + v for v in schemas.WEATHER_VARIABLES)}
      FROM full_days g LEFT JOIN w ON w.event_ts_utc = g.event_ts_utc"""),
)
def silver_weather_query(f):
    root = shared_dir(f.spark, "silver-weather")
    tables.write_days(silver.silver_weather(_landed_weather(f), f.first_day, f.last_day), root)
    return tables.read_days(f.spark, root)


_CALENDAR_COLUMNS = """dt, CAST(isodow(dt) - 1 AS INT) AS day_of_week, CAST(day(dt) AS INT) AS day_of_month,
  CAST(weekofyear(dt) AS INT) AS week_of_year, CAST(month(dt) AS INT) AS month, CAST(year(dt) AS INT) AS year,
  isodow(dt) >= 6 AS is_weekend, false AS is_holiday, isodow(dt) < 6 AS is_working_day,
  CASE WHEN month(dt) IN (12,1,2) THEN 'winter' WHEN month(dt) IN (3,4,5) THEN 'spring'
       WHEN month(dt) IN (6,7,8) THEN 'summer' ELSE 'autumn' END AS season"""


@query(
    "calendar_days",
    f"""WITH d AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS dt FROM orders)
        SELECT {_CALENDAR_COLUMNS} FROM d""",
)
def calendar_days_query(f):
    first, last = day_bounds(f.orders, "o_orderdate")
    return silver.calendar_days(f.spark, first, last)


@query(
    "calendar_documents",
    f"""WITH d AS (SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS DATE) AS dt FROM events)
        SELECT {_CALENDAR_COLUMNS} FROM d""",
)
def calendar_documents(f):
    """Derived calendar landed as one document per day, then read as silver."""
    root = shared_dir(f.spark, "bronze-calendar")
    days = f.calendar.select("dt")
    bronze.write_documents(bronze.calendar_documents(days, F.lit("2024-02-01").cast("timestamp")), root)
    return silver.silver_calendar(bronze.read_calendar(f.spark, root))


@query(
    "silver_calendar_stored",
    f"""WITH d AS (SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS DATE) AS dt FROM events)
        SELECT {_CALENDAR_COLUMNS} FROM d""",
)
def silver_calendar_stored(f):
    """Calendar documents to a table by day that is written twice and stays the same."""
    landed, root = shared_dir(f.spark, "bronze-calendar"), shared_dir(f.spark, "calendar")
    documents = bronze.calendar_documents(f.calendar.select("dt"), F.lit("2024-02-01").cast("timestamp"))
    bronze.write_documents(documents, landed)
    for _ in range(2):
        tables.write_days(silver.silver_calendar(bronze.read_calendar(f.spark, landed)), root)
    return tables.read_days(f.spark, root)


@query("bag_union", "SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'click'")
def bag_union(f):
    """Two file tables with rows in common, all of them kept."""
    roots = [shared_dir(f.spark, name) for name in ("all", "clicks")]
    events = f.events.select("event_id", "event_type")
    events.write.parquet(roots[0])
    events.where(F.col("event_type") == "click").write.parquet(roots[1])
    return tables.read_many(f.spark, roots)


@query(
    "partition_roundtrip",
    with_frames("""SELECT event_ts_utc, dt, series_id, load_mw FROM demand, run WHERE dt BETWEEN d - 7 AND d"""),
)
def partition_roundtrip(f):
    root = shared_dir(f.spark, "days")
    tables.write_days(f.demand, root)
    return tables.read_days(f.spark, root, f.run_day - timedelta(days=7), f.run_day, ["event_ts_utc", "dt", "series_id", "load_mw"])


@query(
    "history_upsert",
    with_frames("""SELECT forecast_run_date, target_date, event_ts_utc, series_id,
        y_hat_mw + CASE WHEN target_date >= d THEN 1 ELSE 0 END AS y_hat_mw, model_name FROM forecasts, run
      UNION ALL
      SELECT forecast_run_date, target_date, event_ts_utc, series_id, y_hat_mw, model_name FROM candidates"""),
)
def history_upsert(f):
    """Two models written by key; then the newest days of one again with other values, twice."""
    root = shared_dir(f.spark, "forecasts")
    keys = ["series_id", "event_ts_utc", "target_date", "model_name"]
    columns = ["forecast_run_date", "target_date", "event_ts_utc", "series_id", "y_hat_mw", "model_name"]
    naive = f.forecasts.select(*columns)
    rerun = naive.where(F.col("target_date") >= F.lit(f.run_day)).withColumn("y_hat_mw", F.col("y_hat_mw") + 1)
    for batch in (naive, f.candidates.select(*columns), rerun, rerun):
        tables.upsert(batch, root, keys, ["target_date"])
    return f.spark.read.parquet(root)


@query(
    "actuals_backfill",
    with_frames("SELECT event_ts_utc, series_id, load_mw, dt FROM gold_train"),
)
def actuals_backfill(f):
    root = shared_dir(f.spark, "actuals")
    rows = actuals(f.gold(), F.lit("2024-02-01").cast("timestamp"))
    for _ in range(2):  # a rerun changes nothing
        tables.write_days(rows, root)
    return tables.read_days(f.spark, root, columns=["event_ts_utc", "series_id", "load_mw", "dt"])


@query(
    "day_slice_half_open",
    """WITH run AS (SELECT CAST(max(ts) AS DATE) - 1 AS d FROM events)
       SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, value FROM events, run
       WHERE epoch_us(ts) >= epoch_us(CAST(d AS TIMESTAMP)) AND epoch_us(ts) < epoch_us(CAST(d + 1 AS TIMESTAMP))""",
)
def day_slice_half_open(f):
    start, end = timefns.day_bounds(F.lit(day_bounds(f.events, "ts")[1] - timedelta(days=1)))
    return f.events.where((F.col("ts") >= start) & (F.col("ts") < end)).select("event_id", to_millis(F.col("ts")).alias("ts_ms"), "value")


@query(
    "scalar_datetime",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, CAST(ts AS DATE) AS dt, date_trunc('hour', ts) AS hour_ts,
         CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute, CAST(dayofweek(ts) + 1 AS INT) AS dow_sunday1,
         CAST(isodow(ts) - 1 AS INT) AS dow_monday0, CAST(weekofyear(ts) AS INT) AS iso_week,
         CAST(ts AS DATE) + 1 AS next_day, CAST(ts AS DATE) - 35 AS history_start,
         strftime(ts, '%Y-%m-%dT%H:%M') AS text, date_trunc('minute', ts) AS parsed, NULL::TIMESTAMP AS unparsed,
         CAST(ts + INTERVAL 1 HOUR AS DATE) AS berlin_winter_day
       FROM events""",
)
def scalar_datetime(f):
    ts = F.col("ts")
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm")
    return f.events.select(
        "event_id",
        F.unix_seconds(ts).alias("epoch_s"),
        F.to_date(ts).alias("dt"),
        F.date_trunc("hour", ts).alias("hour_ts"),
        F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"),
        F.dayofweek(ts).alias("dow_sunday1"),
        F.weekday(ts).alias("dow_monday0"),
        F.weekofyear(ts).alias("iso_week"),
        F.date_add(F.to_date(ts), 1).alias("next_day"),
        F.date_sub(F.to_date(ts), 35).alias("history_start"),
        text.alias("text"),
        F.try_to_timestamp(text).alias("parsed"),
        F.try_to_timestamp(F.concat(F.lit("x"), text)).alias("unparsed"),
        local_day(ts, "Europe/Berlin").alias("berlin_winter_day"),
    )


@query(
    "local_day_hours",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders)
       SELECT dt, CAST(CASE WHEN isodow(dt) = 7 AND day(dt) >= 25 AND month(dt) = 3 THEN 23
                            WHEN isodow(dt) = 7 AND day(dt) >= 25 AND month(dt) = 10 AND year(dt) >= 1996 THEN 25
                            WHEN isodow(dt) = 7 AND day(dt) >= 24 AND month(dt) = 9 AND year(dt) < 1996 THEN 25 ELSE 24 END AS INT) AS n_hours FROM d""",
)
def local_day_hours(f):
    """Length of each order day in Berlin; the oracle states the European rule, which moved autumn's change in 1996."""
    days = f.orders.select(F.to_date("o_orderdate").alias("dt")).distinct()
    return days.select("dt", hours_in_local_day(F.col("dt"), "Europe/Berlin").alias("n_hours"))


@query(
    "scalar_misc",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         round(abs(value - 50), 6) AS distance, round(sqrt(value), 6) AS root,
         round(CASE WHEN value > 0 THEN ln(value) END, 6) AS log_value,
         round(value / nullif(CAST(json_extract_string(props, '$.k') AS INT), 0), 9) AS per_k,
         coalesce(json_extract_string(props, '$.missing'), 'none') AS fallback,
         event_type || '/' || strftime(ts, '%Y-%m-%d') AS path,
         value >= 100 AS is_large, value <> 0 AS is_nonzero
       FROM events""",
)
def scalar_misc(f):
    props = F.from_json("props", "k INT")
    k, value = props["k"], F.col("value")
    wrapped = F.to_json(F.struct(props.alias("p")))
    return f.events.select(
        "event_id",
        F.get_json_object(wrapped, "$.p.k").cast("int").alias("k"),
        F.round(F.abs(value - 50), 6).alias("distance"),
        F.round(F.sqrt(value), 6).alias("root"),
        F.round(F.log(F.when(value > 0, value)), 6).alias("log_value"),
        F.round(value / F.nullif(k, F.lit(0)), 9).alias("per_k"),
        F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("fallback"),
        F.concat_ws("/", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("path"),
        (value >= 100).alias("is_large"),
        (value != 0).alias("is_nonzero"),
    )


@query(
    "silver_silent_series",
    with_frames("""
      SELECT h.event_ts_utc, CAST(h.event_ts_utc AS DATE) AS dt, s.region,
        (SELECT max(value) FROM events e WHERE e.event_type = s.region AND date_trunc('hour', e.ts) = h.event_ts_utc) AS load_mw
      FROM hours h, run, (SELECT DISTINCT event_type AS region FROM events UNION ALL SELECT 'silent') s
      WHERE CAST(h.event_ts_utc AS DATE) = d"""),
)
def silver_silent_series(f):
    """One day of silver when one of the series so far sends nothing; only that day's folders are read."""
    root = shared_dir(f.spark, "bronze-demand")
    bronze.write_documents(bronze.demand_documents(_event_points(f)), root)
    day = f.run_day
    earlier = _event_points(f).withColumn("region", F.lit("silent")).unionByName(_event_points(f))
    documents = bronze.read_demand(f.spark, root, day, day)
    return silver.silver_demand(documents, day, day, series=earlier).select("event_ts_utc", "dt", "region", "load_mw")
