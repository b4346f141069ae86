"""Rolling-origin backtest of a model that is fitted again at every origin, from running sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.functions import accuracy
from loadlake.functions.timefns import DAY
from loadlake.sources.tables import stored

#: Days of the weekly input, which bounds the horizon.
WEEK = 7
#: Inputs that say the same to this share share their weight.
RCOND = 1e-12


def samples(demand: DataFrame, horizon_days: int) -> DataFrame:
    """(series_id, dt, horizon_day, y, recent, week): each load with the loads known ``horizon_day`` days before it.

    ``recent`` is the load at the same hour so many days earlier, the last day
    known at the origin, ``week`` the one a week earlier. Each load is handed
    to the hours it is an input of, and one aggregation by (series, hour)
    brings these together; no join. Of several rows of an hour the largest load
    counts. Rows that lack one of the three numbers are left out.
    """
    if not 1 <= horizon_days <= WEEK:
        raise ValueError(f"the horizon is 1 to {WEEK} days")
    lags = sorted({0, WEEK, *range(1, horizon_days + 1)})
    handed = demand.where(F.col("load_mw").isNotNull() & ~F.isnan("load_mw")).select(
        "series_id",
        F.col("load_mw").cast("double").alias("load_mw"),
        F.unix_seconds("event_ts_utc").alias("_at"),
        F.explode(F.array(*[F.lit(lag) for lag in lags])).alias("_lag"),
    )
    wide = handed.groupBy("series_id", (F.col("_at") + F.col("_lag") * DAY).alias("_at")).agg(
        *[F.max(F.when(F.col("_lag") == lag, F.col("load_mw"))).alias(f"_{lag}") for lag in lags]
    )
    each = F.array(*[F.struct(F.lit(h).alias("horizon_day"), F.col(f"_{h}").alias("recent")) for h in range(1, horizon_days + 1)])
    return (
        wide.where(F.col("_0").isNotNull() & F.col(f"_{WEEK}").isNotNull())
        .select("series_id", F.to_date(F.timestamp_seconds("_at")).alias("dt"), F.col("_0").alias("y"), F.col(f"_{WEEK}").alias("week"), F.inline(each))
        .where(F.col("recent").isNotNull())
    )


def fitted_lines(
    rows: DataFrame,
    features: Sequence[str],
    first: date,
    last: date,
    step_days: int = 1,
    train_days: int | None = None,
    min_rows: int = 2,
) -> DataFrame:
    """(series_id, horizon_day, origin, n_train, weights): a least-squares line at every origin; ``weights`` has the intercept first.

    ``rows`` has series_id, horizon_day, dt, y and ``features``. The line of an
    origin learns from the days before it, all or the last ``train_days``, if
    these have ``min_rows`` rows.

    The normal equations are sums over rows, so they are summed once by
    (series, horizon, day), before the shuffle, and over the days by a window;
    no row is read again for another origin, and a window holds a row per day
    and origin. One small system is solved for each origin, a batch of them at
    once in compiled code. Loads are taken relative to the series' first known
    load of the horizon, so that large ones lose no digits.
    """
    group = ["series_id", "horizon_day"]
    # Any number near the loads will do, as long as it is the same for all rows of a group.
    base = stored(rows.groupBy(*group).agg(F.min("y").alias("_base")), "backtest-bases")
    x: list[Column] = [F.lit(1.0), *[F.col(c) - F.col("_base") for c in features]]
    y = F.col("y") - F.col("_base")
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    sums = {f"_a{i}_{j}": x[i] * x[j] for i, j in pairs} | {f"_b{i}": c * y for i, c in enumerate(x)}
    daily = rows.join(base, group).groupBy(*group, "_base", "dt").agg(F.count("*").alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()])
    counters = ["_n", *sums]
    origins = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr(f"INTERVAL {step_days} DAY"))).alias("dt")
    asked = base.select(*group, "_base", origins, F.lit(True).alias("_asked"))
    days = daily.withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    start = Window.unboundedPreceding if train_days is None else -train_days
    before = Window.partitionBy(*group).orderBy(F.unix_date("dt")).rangeBetween(start, -1)
    known = days.select(*group, "dt", "_base", "_asked", *[F.sum(c).over(before).alias(c) for c in counters]).where("_asked")
    known = known.where(F.col("_n") >= min_rows).select(
        *group,
        F.col("dt").alias("origin"),
        F.col("_n").alias("n_train"),
        "_base",
        F.array(*[F.col(f"_a{min(i, j)}_{max(i, j)}") for i in range(len(x)) for j in range(len(x))]).alias("_a"),
        F.array(*[F.col(f"_b{i}") for i in range(len(x))]).alias("_b"),
    )
    schema = T.StructType([known.schema[c] for c in [*group, "origin", "n_train"]] + [T.StructField("weights", T.ArrayType(T.DoubleType()))])
    return known.mapInArrow(solver(len(x)), schema)


def solver(k: int):
    """Batches of (..., _base, _a, _b) to batches of (..., weights) in terms of the loads themselves."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            base = np.asarray(batch.column("_base"), np.float64)
            a = np.asarray(batch.column("_a").flatten(), np.float64).reshape(-1, k, k)
            b = np.asarray(batch.column("_b").flatten(), np.float64).reshape(-1, k)
            # Columns of equal size; one that is zero throughout has weight 0.
            size = np.sqrt(np.einsum("nii->ni", a))
            scale = np.where(size > 0, 1 / np.where(size > 0, size, 1), 0.0)
            inverse = np.linalg.pinv(a * scale[:, :, None] * scale[:, None, :], rcond=RCOND, hermitian=True)
            w = np.einsum("nij,nj->ni", inverse, b * scale) * scale
            w[:, 0] += base * (1 - w[:, 1:].sum(axis=1))
            weights = pa.ListArray.from_arrays(np.arange(0, w.size + 1, k, dtype=np.int32), w.ravel())
            kept = [batch.column(i) for i in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays([*kept, weights], names=[*batch.schema.names[:-3], "weights"])

    return solved


def refitted_backtest(
    demand: DataFrame,
    first: date,
    last: date,
    step_days: int = 1,
    horizon_days: int = 3,
    train_days: int | None = None,
    min_rows: int = 2,
) -> DataFrame:
    """Accuracy of a line fitted again from every ``step_days``-th origin of [first, last], per series, origin and day ahead.

    Columns: series_id, origin, horizon_day, n_train, intercept, recent, week
    (the line), mae, rmse, n. An origin is the start of a day; the line for the
    h-th day after it learns from loads before the origin only and its inputs
    lie before the origin, too. A row of the samples is judged by one origin
    for each horizon, found by its date, so nothing is compared by range.

    Series and origins with fewer than ``min_rows`` known rows have no line and
    no row; so has a day without loads. Rows without a series, time or load are
    left out, other columns not read.
    """
    rows = stored(samples(demand, horizon_days), "backtest-samples")
    features = ["recent", "week"]
    # A row per series, horizon and origin; written, so that its size decides how it meets the samples.
    lines = stored(fitted_lines(rows, features, first, last, step_days, train_days, min_rows), "backtest-lines")
    judged = rows.withColumn("origin", F.date_sub("dt", F.col("horizon_day") - 1)).join(lines, ["series_id", "horizon_day", "origin"])
    w = [F.get("weights", F.lit(i)) for i in range(len(features) + 1)]
    y_hat = sum((w[i + 1] * F.col(c) for i, c in enumerate(features)), w[0])
    line = [w[0].alias("intercept"), *[w[i + 1].alias(c) for i, c in enumerate(features)]]
    scored = judged.select("series_id", "origin", "horizon_day", "n_train", "y", y_hat.alias("y_hat"), F.struct(*line).alias("line"))
    return (
        scored.groupBy("series_id", "origin", "horizon_day", "n_train", "line")
        .agg(accuracy.mae(F.col("y"), F.col("y_hat")).alias("mae"), accuracy.rmse(F.col("y"), F.col("y_hat")).alias("rmse"), F.count("*").alias("n"))
        .select("series_id", "origin", "horizon_day", "n_train", "line.*", "mae", "rmse", "n")
    )
