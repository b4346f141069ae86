"""Hard and soft data checks as one aggregation per table.

A check table has the columns group keys, ``check``, ``severity``,
``violations`` and ``passed``. Hard checks always fail a day, soft ones only
under a strict gate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.functions.timefns import as_date, hours_in_local_day, local_day

ROWS_PER_DAY = 24

# Whether a table's soft checks fail a day unless told otherwise.
STRICT_BY_DEFAULT = {"demand": True, "weather": False, "calendar": True, "gold": True}


class DataQualityError(AssertionError):
    """A gate found failing checks."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def nulls(column: str) -> Column:
    return F.col(column).isNull()


def check_table(
    df: DataFrame,
    keys: Sequence[str],
    unique_on: str,
    hard: dict[str, Column],
    soft: dict[str, Column],
    rows_per_key: int | Column,
    rows_check: str,
    rows_severity: str,
    missing: dict[str, int],
    expected: DataFrame | None = None,
) -> DataFrame:
    """Count violating rows per ``keys`` for every check at once.

    Rows are first reduced per (keys, ``unique_on``), which finds duplicates
    without a distinct set per key and spreads a large key. ``expected`` lists
    keys, or some columns of them, that must be present: an absent one has no
    rows and fails ``present`` and the row count, and keys beyond it are checked
    like the others. ``missing`` counts absent columns per check name.
    """
    counters = {**hard, **soft}
    tally = df.groupBy(*keys, unique_on).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(p).alias(f"_c{i}") for i, p in enumerate(counters.values())]
    )
    summary = tally.groupBy(*keys).agg(
        F.sum("_rows").alias("_rows"),
        F.count(unique_on).alias("_distinct"),
        *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counters))],
    )
    if expected is not None:
        counts = [c for c in summary.columns if c not in keys]
        named = [k for k in keys if k in expected.columns]
        summary = expected.select(*named).distinct().join(summary, named, "full").select(*keys, *counts).na.fill(0, counts)

    def row(name: str, severity: str, violations: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"), F.lit(severity).alias("severity"), violations.cast("bigint").alias("violations")
        )

    rows = [
        row("present", "hard", F.when(F.col("_rows") == 0, 1).otherwise(0)),
        row(f"unique_{unique_on}", "hard", F.col("_rows") - F.col("_distinct")),
        row(rows_check, rows_severity, F.abs(F.col("_rows") - rows_per_key)),
        *[row(name, "soft" if name.startswith("critical") else "hard", F.lit(n)) for name, n in missing.items()],
        *[row(name, "hard" if name in hard else "soft", F.col(f"_c{i}")) for i, name in enumerate(counters)],
    ]
    return summary.select(*keys, F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def _day(df: DataFrame, run_date: date | str | None, zone: str = "UTC") -> tuple[DataFrame, Column]:
    """The rows with the day they were delivered for in ``_run``, and the test that ``dt`` is wrong.

    With ``run_date`` the whole frame is that day's delivery. Without it each
    row is judged under its ``dt``, which must be the day of its timestamp.
    """
    if run_date is not None:
        day = as_date(run_date)
        return df.withColumn("_run", day), ~F.col("dt").cast("date").eqNullSafe(day)
    wrong = nulls("dt")
    if "event_ts_utc" in df.columns:
        wrong = ~F.col("dt").cast("date").eqNullSafe(local_day(F.col("event_ts_utc"), zone))
    return df.withColumn("_run", F.col("dt").cast("date")), wrong


def _table_check(
    df: DataFrame,
    required: Sequence[str],
    entity: Sequence[str],
    hard: dict[str, Column],
    soft: dict[str, Column],
    run_date: date | str | None,
    expected: DataFrame | None,
    extra_missing: dict[str, int] | None = None,
    zone: str = "UTC",
) -> DataFrame:
    absent = missing_columns(df, required)
    for column in absent:
        df = df.withColumn(column, F.lit(None).cast("string"))
    df, wrong_day = _day(df, run_date, zone)
    checked = check_table(
        df,
        ["_run", *entity],
        "event_ts_utc",
        {"event_ts_utc_not_null": nulls("event_ts_utc"), "dt_matches": wrong_day, **hard},
        soft,
        ROWS_PER_DAY if zone == "UTC" else hours_in_local_day(F.col("_run"), zone),
        "rows_24",
        "soft",
        {"required_columns": len(absent), **(extra_missing or {})},
        None if expected is None else expected.withColumnRenamed("dt", "_run"),
    )
    return checked.withColumnRenamed("_run", "dt")


def check_silver_demand(
    df: DataFrame, run_date: date | str | None = None, expected: DataFrame | None = None, zone: str = "UTC"
) -> DataFrame:
    """Checks per day and series (source, filter, region, resolution); days of another ``zone`` may have 23 or 25 hours.

    ``expected`` has ``dt`` and some or all columns of a series. Every series
    of a region has its own rows of a day, so two filters are no duplicates.
    """
    return _table_check(
        df,
        schemas.SILVER_DEMAND_REQUIRED,
        schemas.SERIES_COLUMNS,
        {},
        {"load_mw_not_null": nulls("load_mw"), "load_mw_not_negative": F.col("load_mw") < 0},
        run_date,
        expected,
        zone=zone,
    )


def check_silver_weather(
    df: DataFrame, run_date: date | str | None = None, expected: DataFrame | None = None
) -> DataFrame:
    """Checks per (dt, location_name)."""
    return _table_check(
        df,
        schemas.SILVER_WEATHER_REQUIRED,
        ["location_name"],
        {},
        {f"{v}_not_null": nulls(v) for v in schemas.WEATHER_VARIABLES},
        run_date,
        expected,
    )


def check_silver_calendar(
    df: DataFrame, run_date: date | str | None = None, expected: DataFrame | None = None
) -> DataFrame:
    """Checks per dt, all of them hard: one row, nothing NULL, the right day."""
    absent = missing_columns(df, schemas.SILVER_CALENDAR_REQUIRED)
    for column in absent:
        df = df.withColumn(column, F.lit(None))
    df, wrong_day = _day(df, run_date)
    checked = check_table(
        df,
        ["_run"],
        "dt",
        {"dt_matches": wrong_day, **{f"{c}_not_null": nulls(c) for c in schemas.SILVER_CALENDAR_REQUIRED}},
        {},
        1,
        "rows_1",
        "hard",
        {"required_columns": len(absent)},
        None if expected is None else expected.withColumnRenamed("dt", "_run"),
    )
    return checked.withColumnRenamed("_run", "dt")


def check_gold(df: DataFrame, run_date: date | str | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Checks per (dt, series_id)."""
    critical = schemas.GOLD_CRITICAL_FEATURES
    return _table_check(
        df,
        schemas.GOLD_REQUIRED,
        ["series_id"],
        {"series_id_not_null": nulls("series_id")},
        {
            "load_mw_not_null": nulls("load_mw"),
            f"{schemas.LABEL}_not_null": nulls(schemas.LABEL),
            "load_mw_not_negative": F.col("load_mw") < 0,
            **{f"{c}_not_null": nulls(c) for c in critical if c in df.columns},
        },
        run_date,
        expected,
        {"critical_columns": len(missing_columns(df, critical))},
    )


def failures(checks: DataFrame, strict: bool) -> DataFrame:
    """Checks that fail their day."""
    fails = F.col("severity") == "hard"
    return checks.where(~F.col("passed") & (fails | F.lit(strict)))


def day_verdicts(checks: DataFrame, strict: bool) -> DataFrame:
    """``pass``, ``warn`` or ``fail`` per day, with the number of checks that did not pass."""
    hard = F.count_if(~F.col("passed") & (F.col("severity") == "hard"))
    soft = F.count_if(~F.col("passed") & (F.col("severity") == "soft"))
    return checks.groupBy("dt").agg(
        F.when((hard > 0) | (F.lit(strict) & (soft > 0)), "fail").when(soft > 0, "warn").otherwise("pass").alias("verdict"),
        hard.alias("hard_failures"),
        soft.alias("soft_failures"),
    )


def enforce(checks: DataFrame, strict: bool, shown: int = 20) -> None:
    """Raise if any check fails; the message names the first ``shown`` failures."""
    failed = failures(checks, strict).take(shown)
    if failed:
        raise DataQualityError("; ".join(", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in failed))
