"""Leakage-safe training sets from gold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loadlake.sources.tables import EmptyTableError, write_partitions

HISTORY_DAYS = 365
VALIDATION_DAYS = 30
GAP_DAYS = 1


@dataclass(frozen=True)
class SplitDates:
    """First day, first validation day, first test day (if any) and last day of a training set."""

    start: date
    val_start: date
    test_start: date | None
    end: date


def split_dates(
    run_date: date, history_days: int = HISTORY_DAYS, val_days: int = VALIDATION_DAYS, test_days: int = 0
) -> SplitDates:
    """The last ``history_days`` before ``run_date``, ending with validation and then test days."""
    end = run_date - timedelta(days=1)
    val_end = end - timedelta(days=test_days)
    return SplitDates(
        start=end - timedelta(days=history_days - 1),
        val_start=val_end - timedelta(days=val_days - 1),
        test_start=val_end + timedelta(days=1) if test_days else None,
        end=end,
    )


def train_val_split(gold: DataFrame, dates: SplitDates, gap_days: int = GAP_DAYS) -> DataFrame:
    """Gold rows of the range with ``split`` train, val or test.

    The label of a day is the load of the next day, so the last ``gap_days``
    before each boundary belong to neither side and are left out.
    """
    dt = F.col("dt")

    def in_gap(boundary: date):
        return (dt < F.lit(boundary)) & (dt >= F.lit(boundary - timedelta(days=gap_days)))

    split = F.when(dt < F.lit(dates.val_start), "train")
    gap = in_gap(dates.val_start)
    if dates.test_start is not None:
        split = split.when(dt >= F.lit(dates.test_start), "test")
        gap = gap | in_gap(dates.test_start)
    return (
        gold.where(dt.between(F.lit(dates.start), F.lit(dates.end)))
        .where(~gap)
        .withColumn("split", split.otherwise("val"))
    )


def split_counts(splits: DataFrame) -> DataFrame:
    """Rows and distinct days per split."""
    return (
        splits.groupBy("split", "dt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("split")
        .agg(F.sum("_n").alias("n_rows"), F.count("dt").alias("n_days"))
    )


def write_trainset(splits: DataFrame, root: str, run_date: date) -> None:
    """Store the splits under ``run_date=/split=``; an empty train or validation split is an error.

    The rows are counted as they are written, so the plan runs once.
    """
    seen = Observation("splits")
    counted = splits.observe(seen, *[F.count_if(F.col("split") == part).alias(part) for part in ("train", "val")])
    write_partitions(counted.withColumn("run_date", F.lit(run_date)), root, ["run_date", "split"])
    if not all(seen.get.values()):
        raise EmptyTableError(f"train and val must both have rows, found {seen.get}")
