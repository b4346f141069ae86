from datetime import date

import pytest
from pyspark.sql import functions as F

from loadlake.operators.samples import numeric_features
from loadlake.plans import model, trainset
from loadlake.sources.tables import EmptyTableError


@pytest.fixture(scope="module")
def gold(spark):
    """60 days of one series whose label is a plain function of its features, with NULL features."""
    return spark.range(60 * 24).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("event_ts_utc"),
        F.lit("DE").alias("series_id"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.when(F.col("id") % 11 != 0, 100.0 + (F.col("id") % 24) * 10).alias("load_mw"),
        F.lit(None).cast("double").alias("never"),
        (F.col("id") % 2 == 0).alias("flag"),
        (100.0 + (F.col("id") % 24) * 10).alias("target_load_mw"),
    ).withColumn("dt", F.to_date("event_ts_utc"))


DATES = trainset.split_dates(date(2024, 3, 1), history_days=40, val_days=10, test_days=5)


def test_split_dates():
    plain = trainset.split_dates(date(2024, 3, 1))
    assert (plain.start, plain.val_start, plain.end) == (date(2023, 3, 2), date(2024, 1, 31), date(2024, 2, 29))
    assert (DATES.start, DATES.val_start, DATES.test_start, DATES.end) == (
        date(2024, 1, 21), date(2024, 2, 15), date(2024, 2, 25), date(2024, 2, 29))


def test_splits_are_apart_by_the_gap(gold):
    days = {r.split: (r.a, r.b) for r in trainset.train_val_split(gold, DATES).groupBy("split").agg(F.min("dt").alias("a"), F.max("dt").alias("b")).collect()}
    assert days == {
        "train": (date(2024, 1, 21), date(2024, 2, 13)),
        "val": (date(2024, 2, 15), date(2024, 2, 23)),
        "test": (date(2024, 2, 25), date(2024, 2, 29)),
    }
    no_gap = trainset.train_val_split(gold, trainset.split_dates(date(2024, 3, 1), 40, 10), gap_days=0)
    counts = {r.split: (r.n_rows, r.n_days) for r in trainset.split_counts(no_gap).collect()}
    assert counts == {"train": (720, 30), "val": (240, 10)}


def test_empty_split_is_an_error(gold, tmp_path):
    only_train = trainset.train_val_split(gold.where("dt < '2024-02-10'"), DATES)
    with pytest.raises(EmptyTableError):
        trainset.write_trainset(only_train, str(tmp_path / "t"), date(2024, 3, 1))


def test_numeric_features_leave_out_booleans_and_meta(gold):
    assert numeric_features(gold) == ["hour", "load_mw", "never"]


def test_fit_score_and_mismatch(spark, gold, tmp_path):
    splits = trainset.train_val_split(gold, DATES)
    fitted = model.train_gbt(splits, max_iter=15, step_size=0.3)
    assert model.model_features(fitted) == ["hour", "load_mw"]
    scored = model.score(fitted, splits.where("split = 'test'"))
    assert "features" not in scored.columns and "hour_filled" not in scored.columns
    metrics = model.evaluate(scored).first()
    spread = splits.agg(F.stddev("target_load_mw")).first()[0]
    assert metrics.rmse < 0.2 * spread
    with pytest.raises(model.FeatureMismatchError, match="load_mw"):
        model.score(fitted, gold.drop("load_mw"))
    forecast = model.batch_forecast(scored, "m", "run1", F.lit("2024-03-01").cast("timestamp"))
    assert forecast.columns == ["forecast_run_date", "target_date", "event_ts_utc", "series_id", "y_hat_mw", "model_name",
                                "model_run_id", "horizon_hours", "created_at_utc"]
    assert forecast.where("datediff(target_date, forecast_run_date) <> 1 OR horizon_hours <> 24").isEmpty()


def test_medians_come_from_training_rows(gold):
    odd = gold.withColumn("load_mw", F.when(F.col("dt") >= "2024-02-15", F.lit(1e9)).otherwise(F.col("load_mw")))
    fitted = model.train_gbt(trainset.train_val_split(odd, DATES), ["hour", "load_mw"], max_iter=1)
    assert fitted.stages[0].surrogateDF.first().load_mw < 1000


def test_best_and_approved_runs(spark):
    runs = spark.sql("""SELECT * FROM VALUES (1, 5.0D, 'approved', timestamp'2024-01-01'), (2, 3.0D, 'rejected', timestamp'2024-01-03'),
        (3, 3.0D, 'approved', timestamp'2024-01-02'), (4, CAST(NULL AS DOUBLE), 'rejected', timestamp'2024-01-04') AS t(run_id, rmse, status, created_at)""")
    assert model.best_run(runs).first().run_id == 2
    assert model.last_approved_run(runs).first().run_id == 3


def test_best_round_waits_for_patience():
    assert model.best_round([5, 4, 3, 4, 4, 2, 1], patience=10) == 7
    assert model.best_round([5, 4, 3, 4, 4, 2, 1], patience=2) == 3
    assert model.best_round([1.0], patience=50) == 1


def test_boosting_goes_on_while_validation_gains(gold):
    splits = trainset.train_val_split(gold, DATES)
    few = model.train_gbt(splits, max_iter=1, max_depth=2, step_size=0.3)
    many = model.train_gbt(splits, max_iter=40, patience=5, max_depth=2, step_size=0.3)
    assert few.stages[-1].getNumTrees == 1 < many.stages[-1].getNumTrees

    def rmse(fitted):
        return model.evaluate(model.score(fitted, splits.where("split = 'test'"))).first().rmse

    assert rmse(many) <= rmse(few)
