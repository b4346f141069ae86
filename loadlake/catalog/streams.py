"""Streaming queries replaying the events, run until all input is taken."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.catalog.frames import Frames, rounded, with_frames
from loadlake.catalog.registry import query
from loadlake.session import shared_dir
from loadlake.sources import streams
from loadlake.streaming import intraday


def _events(f: Frames) -> DataFrame:
    """The pattern matches a single file, which a stream takes no plain path of, and a folder of files."""
    return streams.replay_files(f.spark, f"{f.sf_dir}/events.parque[t]")


def _finished(f: Frames, df: DataFrame, name: str) -> DataFrame:
    """Append the stream to a table and read it back."""
    root = shared_dir(f.spark, name)
    intraday.append_to(df, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return f.spark.read.schema(df.schema).parquet(f"{root}/table")


def _materialized(f: Frames, df: DataFrame, name: str, ts: str, mode: str) -> DataFrame:
    """Keep a keyed table current with the stream and read it back."""
    root = shared_dir(f.spark, name)
    intraday.materialize(df, f"{root}/table", f"{root}/checkpoint", ts, mode).awaitTermination()
    return f.spark.read.parquet(f"{root}/table").drop("bucket")


_CLOSED_SQL = """WITH w AS (
    SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, event_type AS series_id, count(*) AS n_events,
      round(avg(value), 6) AS value_mean, max(value) AS value_max, arg_max(value, ts) AS value_last
    FROM events GROUP BY ALL
  ), closed AS (
    SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, series_id, n_events, value_mean, value_max, value_last
    FROM w WHERE window_start + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE FROM events)
  )"""


@query("stream_tumbling", f"{_CLOSED_SQL} SELECT * FROM closed")
def stream_tumbling(f):
    """Windows the watermark has passed."""
    windows = intraday.tumbling_features(_events(f), "event_type", "ts", "value")
    return rounded(_finished(f, windows, "tumbling"), "value_mean")


@query("stream_dedup", "SELECT event_id, ts, event_type, value FROM events")
def stream_dedup(f):
    """Every event arrives twice and is kept once."""
    twice = _events(f).unionByName(_events(f))
    once = intraday.deduplicated(twice, "event_id", "ts").select("event_id", "ts", "event_type", "value")
    return _finished(f, once, "dedup")


@query(
    "stream_stateful",
    """SELECT event_type AS series_id, max(ts) AS last_ts, arg_max(value, ts) AS last_value, count(*) AS n_events,
         round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_std FROM events GROUP BY event_type""",
)
def stream_stateful(f):
    running = intraday.running_features(_events(f), "event_type", "ts", "value")
    return rounded(_materialized(f, running, "running", "last_ts", "update"), "value_mean", "value_std")


@query(
    "stream_latest",
    f"""{_CLOSED_SQL} SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY window_end DESC) = 1""",
)
def stream_latest(f):
    """Newest closed window per series in the online table."""
    windows = intraday.tumbling_features(_events(f), "event_type", "ts", "value")
    return rounded(_materialized(f, windows, "online", "window_end", "append"), "value_mean")


@query(
    "stream_cycle",
    with_frames(f""", {_CLOSED_SQL.removeprefix("WITH ")}, newest AS (
        SELECT series_id, window_start AS ts, value_mean AS value FROM closed
        QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY window_end DESC) = 1
      ), ahead AS (
        SELECT n.*, k AS step, ts + k * INTERVAL 15 MINUTE AS target_ts_utc FROM newest n, range(0, 25) r(k)
      ), j AS (
        SELECT a.*, p.y_hat_mw AS baseline FROM ahead a
        LEFT JOIN forecasts p ON p.series_id = a.series_id AND p.target_ts_utc = date_trunc('hour', a.target_ts_utc)
      ), r AS (SELECT *, max(CASE WHEN step = 0 THEN value - baseline END) OVER (PARTITION BY series_id) AS residual FROM j)
      SELECT series_id, ts AS origin_ts_utc, CAST(step AS INT) AS step, target_ts_utc,
        round(coalesce(baseline + coalesce(residual, 0), value), 5) AS y_hat FROM r WHERE step > 0"""),
)
def stream_cycle(f):
    """Events to online table to 24-step forecasts; the cycle runs twice and is kept once."""
    root = shared_dir(f.spark, "cycle")
    windows = intraday.tumbling_features(_events(f), "event_type", "ts", "value")
    intraday.materialize(windows, f"{root}/store", f"{root}/checkpoint", "window_end", "append").awaitTermination()
    store = f.spark.read.parquet(f"{root}/store")
    for _ in range(2):
        intraday.run_cycle(store, f.forecasts, f"{root}/forecasts")
    kept = f.spark.read.parquet(f"{root}/forecasts").drop("origin_date")
    return rounded(kept, "y_hat", places=5)


@query(
    "stream_late_update",
    """SELECT event_type AS series_id, max(ts) AS last_ts, arg_max(value, ts) AS value_last FROM events GROUP BY event_type""",
)
def stream_late_update(f):
    """The store gets the newest rows first and rows of a day before in a later batch: the newest stand."""
    root = f"{shared_dir(f.spark, 'late')}/store"
    write = intraday.store_writer(root, "last_ts")
    newest = f.events.groupBy(F.col("event_type").alias("series_id")).agg(
        F.max("ts").alias("last_ts"), F.max_by("value", "ts").alias("value_last")
    )
    older = newest.withColumns({"last_ts": F.col("last_ts") - F.expr("INTERVAL 1 DAY"), "value_last": F.lit(-1.0)})
    for batch_id, batch in enumerate((newest, older, newest)):
        write(batch, batch_id)
    return f.spark.read.parquet(root).drop("bucket")
