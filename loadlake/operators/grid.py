"""Regular time grids: rollup to a step and filling of gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.functions.timefns import as_date

STEP = "INTERVAL 1 HOUR"


def hourly_rollup(df: DataFrame, keys: Sequence[str], ts: str = "event_ts_utc", value: str = "load_mw") -> DataFrame:
    """Largest value per (keys, hour); duplicates collapse before the shuffle."""
    return df.groupBy(*keys, F.date_trunc("hour", F.col(ts)).alias("event_ts_utc")).agg(F.max(value).alias("load_mw"))


def day_span(start: date | str | Column, end: date | str | Column, zone: str = "UTC") -> tuple[Column, Column]:
    """First and last hour, in UTC, of the closed range of days of ``zone``."""
    first = F.to_utc_timestamp(F.to_timestamp(as_date(start)), zone)
    after = F.to_utc_timestamp(F.to_timestamp(F.date_add(as_date(end), 1)), zone)
    return first, after - F.expr(STEP)


def grid(series: DataFrame, first: Column, last: Column, ts: str = "event_ts_utc", step: str = STEP) -> DataFrame:
    """Each row of ``series`` at every step of [first, last]."""
    return series.select("*", F.explode(F.sequence(first, last, F.expr(step))).alias(ts))


def fill_grid(
    points: DataFrame,
    keys: Sequence[str],
    first: Column,
    last: Column,
    ts: str = "event_ts_utc",
    value: str = "load_mw",
    step: str = STEP,
    series: DataFrame | None = None,
) -> DataFrame:
    """One row per (keys, step): the largest value of ``points`` there, NULL in a gap.

    ``ts`` of ``points`` is truncated to the step already. The points are
    rolled up first; the empty grid then joins them as rows without a value,
    in a second aggregation over one row per (keys, step). Every series seen in
    ``points`` is laid out, and those of ``series`` too, though they sent nothing.
    """
    inside = points.select(*keys, ts, value).where(F.col(ts).between(first, last))
    rolled = inside.groupBy(*keys, ts).agg(F.max(value).alias(value))
    # The count keeps this branch on the very rollup of the other one, so
    # its shuffle is used twice and the points are read once.
    seen = rolled.groupBy(*keys).agg(F.count(value).alias("_n")).where(F.col("_n") >= 0).select(*keys)
    if series is not None:
        seen = seen.unionByName(series.select(*keys)).distinct()
    empty = grid(seen, first, last, ts, step)
    empty = empty.withColumn(value, F.lit(None).cast(inside.schema[value].dataType))
    return rolled.unionByName(empty).groupBy(*keys, ts).agg(F.max(value).alias(value))


def join_grid(
    rows: DataFrame, series: DataFrame, keys: Sequence[str], first: Column, last: Column, ts: str = "event_ts_utc"
) -> DataFrame:
    """The grid of ``series`` left-joined with ``rows``; duplicate rows stay visible."""
    return grid(series, first, last, ts).join(rows, [*keys, ts], "left")
