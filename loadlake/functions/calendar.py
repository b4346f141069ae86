"""Calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def season(month: Column) -> Column:
    """Meteorological season of the northern hemisphere."""
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("autumn")
    )


def day_columns(day: Column, is_holiday: Column | None = None) -> dict[str, Column]:
    """The nine attributes of ``day``; day_of_week counts from Monday = 0."""
    holiday = F.lit(False) if is_holiday is None else F.coalesce(is_holiday, F.lit(False))
    weekend = F.weekday(day) >= 5
    return {
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "month": F.month(day),
        "year": F.year(day),
        "is_weekend": weekend,
        "is_holiday": holiday,
        "is_working_day": ~weekend & ~holiday,
        "season": season(F.month(day)),
    }


def clock_columns(ts: Column) -> dict[str, Column]:
    """Hour, minute and weekday of a timestamp; day_of_week_ts counts from Sunday = 1."""
    return {"hour": F.hour(ts), "minute": F.minute(ts), "day_of_week_ts": F.dayofweek(ts)}
