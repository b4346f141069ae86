"""Training sets, model fit, scoring and the choice of a run."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.catalog.features import SAME_HOUR_STATS
from loadlake.catalog.frames import WEATHER_SCALES, Frames, rounded, with_frames
from loadlake.catalog.registry import query
from loadlake.operators.history import LOAD_LAGS
from loadlake.plans import model, quantile_regression, trainset
from loadlake.session import shared_dir
from loadlake.sources import tables

# A year of history, as far as there is one; 7 days to validate and 3 to report on,
# since the default of 30 would leave a month of events nothing to learn from.
HISTORY, VALIDATION, TEST = trainset.HISTORY_DAYS, 7, 3

# Every numeric column of the training set but the label, in its order.
_LEARNED = ",".join([
    "load_mw", "hour", "minute", "day_of_week_ts", *LOAD_LAGS, *SAME_HOUR_STATS, *WEATHER_SCALES, "temp_lag_24h",
    "temp_mean_7d", "heating_degree", "cooling_degree", "day_of_week", "day_of_month", "week_of_year", "month", "year",
])

_SPLIT_SQL = """, split AS (
  SELECT *, CASE WHEN dt < d - 10 THEN 'train' WHEN dt >= d - 3 THEN 'test' ELSE 'val' END AS split
  FROM gold_train, run WHERE dt BETWEEN d - 365 AND d - 1 AND dt <> d - 11 AND dt <> d - 4
)"""


def _splits(f: Frames) -> DataFrame:
    dates = trainset.split_dates(f.run_day, HISTORY, VALIDATION, TEST)
    return trainset.train_val_split(f.gold(), dates)


def _stored_splits(f: Frames) -> DataFrame:
    """Splits as a trainer finds them: a stored table, not a plan to run once per round."""
    root = shared_dir(f.spark, "trainsets")
    trainset.write_trainset(_splits(f), root, f.run_day)
    return tables.read_days(f.spark, root)


@query(
    "train_val_split",
    with_frames(f"{_SPLIT_SQL} SELECT split, series_id, event_ts_utc, dt, load_mw, target_load_mw FROM split"),
)
def train_val_split(f):
    """Stored by run date and split, then read back."""
    return _stored_splits(f).select("split", "series_id", "event_ts_utc", "dt", "load_mw", "target_load_mw")


@query(
    "split_counts",
    with_frames(f"{_SPLIT_SQL} SELECT split, count(*) AS n_rows, count(DISTINCT dt) AS n_days FROM split GROUP BY split"),
)
def split_counts(f):
    return trainset.split_counts(_splits(f))


def _gbt_record(f: Frames) -> DataFrame:
    splits = _stored_splits(f)
    fitted = model.train_gbt(splits)
    scored = model.score(fitted, splits.where(F.col("split") == "test"))
    metrics = model.evaluate(scored, baseline="load_mw")
    return model.run_record("gbt", f.run_day, model.model_features(fitted), metrics)


@query("train_gbt")
def train_gbt(f):
    """The run's record: metrics of the test days, which neither fit nor early stopping saw, beside the 24 h naive."""
    return rounded(_gbt_record(f), "rmse", "mae", "mape", "baseline_rmse")


@query(
    "train_gbt_digest",
    with_frames(
        f"""{_SPLIT_SQL}
      SELECT 'gbt' AS run_id, (SELECT d FROM run) AS run_date, 31 AS n_features, '{_LEARNED}' AS feature_names,
        round(sqrt(avg((target_load_mw - load_mw) ** 2)), 6) AS baseline_rmse, true AS beats_baseline
      FROM split WHERE split = 'test'"""
    ),
)
def train_gbt_digest(f):
    """What SQL can say of the run: its features, the naive error, and that the model beats it."""
    record = _gbt_record(f).withColumn("beats_baseline", F.col("rmse") < F.col("baseline_rmse"))
    return rounded(record.drop("rmse", "mae", "mape"), "baseline_rmse")


def _gbt_forecasts(f: Frames) -> DataFrame:
    """Forecasts of the day after the run day for every series, and whether each is within the range of the labels learned from."""
    day = f.run_day
    splits = _stored_splits(f)
    fitted = model.train_gbt(splits)
    span = splits.where(F.col("split") == "train").agg(F.min("target_load_mw").alias("a"), F.max("target_load_mw").alias("b")).first()
    serve = f.gold(mode="serve").where(F.col("dt") == F.lit(day))
    created = F.to_timestamp(F.lit(day + timedelta(days=1)))
    rows = model.batch_forecast(model.score(fitted, serve), model.MODEL_NAME, "gbt", created)
    return rows.withColumn("within_labels", F.col("y_hat_mw").between(span["a"], span["b"]))


@query("batch_forecast")
def batch_forecast(f):
    return rounded(_gbt_forecasts(f).drop("within_labels"), "y_hat_mw")


@query(
    "batch_forecast_digest",
    with_frames(
        f"""{_SPLIT_SQL}
      SELECT dt AS forecast_run_date, dt + 1 AS target_date, event_ts_utc, series_id, 'day_ahead_gbt' AS model_name,
        'gbt' AS model_run_id, 24 AS horizon_hours, CAST(d + 1 AS TIMESTAMP) AS created_at_utc, true AS within_labels
      FROM gold, run WHERE dt = d"""
    ),
)
def batch_forecast_digest(f):
    """What SQL can say of the forecasts: their rows, and that each is within the labels learned from."""
    return _gbt_forecasts(f).drop("y_hat_mw")


@query(
    "best_run",
    """SELECT o_orderkey AS run_id, o_totalprice AS rmse, CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'rejected' END AS status,
         o_orderdate AS created_at FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1""",
)
def best_run(f):
    return model.best_run(f.runs)


@query(
    "last_approved_run",
    """SELECT o_orderkey AS run_id, o_orderdate AS created_at FROM orders WHERE o_orderstatus = 'F'
       ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
)
def last_approved_run(f):
    return model.last_approved_run(f.runs)


@query(
    "foreign_model",
    with_frames("""SELECT series_id, event_ts_utc, round(0.25 * load_mw + 0.5 * load_lag_24h + 1.5 * hour, 6) AS y_hat_mw
      FROM gold_train WHERE load_mw IS NOT NULL"""),
)
def foreign_model(f):
    """A model from outside Spark, called per Arrow batch; here a linear one."""
    gold = f.gold().where(F.col("load_mw").isNotNull())
    rows = gold.select("series_id", "event_ts_utc", "load_mw", "load_lag_24h", "hour")

    def predict(x):
        return 0.25 * x["load_mw"] + 0.5 * x["load_lag_24h"] + 1.5 * x["hour"]

    scored = model.score_with(rows, ["load_mw", "load_lag_24h", "hour"], predict)
    return rounded(scored.select("series_id", "event_ts_utc", "y_hat_mw"), "y_hat_mw")


@query("quantile_forecasts")
def quantile_forecasts(f):
    """P10, P50 and P90 of the load a day ahead on the days after the training rows, by fitted linear quantiles."""
    splits = _stored_splits(f)
    learned = ["load_mw", "load_lag_24h", "load_mean_7d_same_hour"]
    fitted = quantile_regression.fit_quantiles(splits.where("split = 'train'"), learned, "target_load_mw")
    rows = fitted.predict(splits.where("split <> 'train'"))
    return rows.select("split", "series_id", "event_ts_utc", "target_load_mw", "y_hat_p10", "y_hat_p50", "y_hat_p90")
