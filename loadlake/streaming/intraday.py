"""Event-time features of the intraday path, their stores, and the 15-minute forecast cycle.

Aggregations are built in, so each micro-batch is reduced per key before its
shuffle and a series with most of the events does not fill one task. The time
column must be a ``timestamp``; a watermark takes no ``timestamp_ntz``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadlake.operators.asof import latest
from loadlake.sources.tables import upsert

WINDOW = "15 minutes"
LATENESS = "30 minutes"
STEP_SECONDS = 900
HORIZON_STEPS = 24
#: Parts of the online table; a micro-batch rewrites those it has news for, so there should be many more than series in one.
STORE_BUCKETS = 256


def tumbling_features(
    events: DataFrame, series: str, ts: str, value: str, window: str = WINDOW, lateness: str = LATENESS
) -> DataFrame:
    """Count, mean, largest and newest value per (window, series).

    Rows later than ``lateness`` behind the newest event are dropped; raise it
    when a source runs late.
    """
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, window), F.col(series).alias("series_id"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.avg(value).alias("value_mean"),
            F.max(value).alias("value_max"),
            F.max_by(value, ts).alias("value_last"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "series_id", "n_events", "value_mean", "value_max", "value_last")
    )


def deduplicated(events: DataFrame, event_id: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """The first arrival of each event; a replayed event is dropped while the watermark remembers it."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event_id])


def running_features(events: DataFrame, series: str, ts: str, value: str) -> DataFrame:
    """Per series, over everything seen so far: newest value, count, mean and deviation.

    State is one small row per series and outlives any window. Emit in update
    mode.
    """
    return events.groupBy(F.col(series).alias("series_id")).agg(
        F.max(ts).alias("last_ts"),
        F.max_by(value, ts).alias("last_value"),
        F.count(F.lit(1)).alias("n_events"),
        F.avg(value).alias("value_mean"),
        F.stddev(value).alias("value_std"),
    )


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a table, taking all input there is and then stopping.

    A restart with the same ``checkpoint`` goes on where the last run ended.
    """
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def store_writer(path: str, ts: str, buckets: int = STORE_BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function keeping the newest row per series in a keyed table.

    A row that is older than the stored one, such as a late window that is
    emitted again, changes nothing. The table is cut by hash of the series, and
    only buckets with news are read and rewritten. Writing a batch twice gives
    the same table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest(batch, ["series_id"], ts)
        bucketed = newest.withColumn("bucket", F.pmod(F.xxhash64("series_id"), F.lit(buckets)))
        upsert(bucketed, path, ["series_id", "bucket"], ["bucket"], newest=ts)

    return write


def materialize(df: DataFrame, path: str, checkpoint: str, ts: str, mode: str = "update") -> StreamingQuery:
    """Keep the online table at ``path`` current with ``df``."""
    return (
        df.writeStream.foreachBatch(store_writer(path, ts))
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows the query has dropped for being late."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def input_rows(query: StreamingQuery) -> int:
    return sum(p.numInputRows for p in query.recentProgress)


def lag_seconds(query: StreamingQuery, now: datetime) -> float | None:
    """Seconds between ``now`` and the newest event time the query has seen."""
    newest = [p.eventTime["max"] for p in query.recentProgress if "max" in (p.eventTime or {})]
    if not newest:
        return None
    return (now - datetime.fromisoformat(max(newest).replace("Z", "+00:00"))).total_seconds()


def correct_baseline(
    day_ahead: DataFrame, observed: DataFrame, step_seconds: int = STEP_SECONDS, known_after: int = STEP_SECONDS
) -> DataFrame:
    """Day-ahead forecasts on the intraday grid, shifted by the newest residual.

    ``day_ahead`` has ``series_id, target_ts_utc, y_hat_mw`` per hour,
    ``observed`` has ``series_id, ts, value`` per step. The residual of a step
    is known ``known_after`` seconds later; without one the baseline stands.
    """
    offsets = F.sequence(F.lit(0), F.lit(3600 - step_seconds), F.lit(step_seconds))
    steps = day_ahead.select("series_id", "target_ts_utc", "y_hat_mw", F.explode(offsets).alias("_o")).select(
        "series_id",
        F.timestamp_seconds(F.unix_seconds("target_ts_utc") + F.col("_o")).alias("ts"),
        F.col("y_hat_mw").alias("baseline"),
    )
    residuals = observed.join(steps, ["series_id", "ts"]).select(
        "series_id",
        F.timestamp_seconds(F.unix_seconds("ts") + known_after).alias("ts"),
        (F.col("value") - F.col("baseline")).alias("residual"),
    )
    return steps.join(residuals, ["series_id", "ts"], "left").withColumn(
        "corrected", F.col("baseline") + F.coalesce("residual", F.lit(0.0))
    )


def intraday_cycle(
    newest: DataFrame, day_ahead: DataFrame, steps: int = HORIZON_STEPS, step_seconds: int = STEP_SECONDS
) -> DataFrame:
    """One forecast cycle: every series over the next ``steps`` steps.

    ``newest`` has ``series_id, ts, value``, the newest finished window of each
    series. The forecast is the day-ahead baseline plus the residual at ``ts``,
    or the newest value where there is no baseline.
    """
    ahead = newest.select("series_id", "ts", "value", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step")).select(
        "*", F.timestamp_seconds(F.unix_seconds("ts") + F.col("step") * step_seconds).alias("target_ts_utc")
    )
    hourly = day_ahead.select(
        "series_id", F.col("target_ts_utc").alias("_hour"), F.col("y_hat_mw").alias("baseline")
    )
    joined = ahead.withColumn("_hour", F.date_trunc("hour", "target_ts_utc")).join(hourly, ["series_id", "_hour"], "left")
    of_cycle = Window.partitionBy("series_id", "ts")
    residual = F.max(F.when(F.col("step") == 0, F.col("value") - F.col("baseline"))).over(of_cycle)
    return (
        joined.withColumn("_residual", residual)
        .where(F.col("step") > 0)
        .select(
            "series_id",
            F.col("ts").alias("origin_ts_utc"),
            "step",
            "target_ts_utc",
            F.coalesce(F.col("baseline") + F.coalesce("_residual", F.lit(0.0)), F.col("value")).alias("y_hat"),
        )
    )


def run_cycle(store: DataFrame, day_ahead: DataFrame, path: str, value: str = "value_mean") -> None:
    """Forecast from the online table and keep the result by (series, origin, step), so a repeated cycle adds nothing.

    The newest finished window of a series is its origin; call this on the
    15-minute schedule, after ``materialize`` has taken the new events.
    """
    newest = store.select("series_id", F.col("window_start").alias("ts"), F.col(value).alias("value"))
    forecasts = intraday_cycle(newest, day_ahead).withColumn("origin_date", F.to_date("origin_ts_utc"))
    upsert(forecasts, path, ["origin_date", "series_id", "origin_ts_utc", "step"], ["origin_date"])


def rebin(events: DataFrame, series: str, ts: str, value: str, step: str = WINDOW) -> DataFrame:
    """Batch twin of the tumbling mean: ``series_id, ts, value`` per step."""
    return events.groupBy(F.col(series).alias("series_id"), F.window(ts, step)["start"].alias("ts")).agg(
        F.avg(value).alias("value")
    )
