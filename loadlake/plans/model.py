"""Gradient-boosted day-ahead model: fit, choose, score."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.functions import accuracy
from loadlake.operators.samples import numeric_features

MODEL_NAME = "day_ahead_gbt"
HORIZON_HOURS = 24


class FeatureMismatchError(ValueError):
    """The rows to score lack features the model was fitted on."""


def usable_features(train: DataFrame, names: Sequence[str]) -> list[str]:
    """Features with at least one value in the training rows; the others have no median."""
    filled = train.agg(*[F.count(n).alias(n) for n in names]).first()
    return [n for n in names if filled[n] > 0]


def train_gbt(
    splits: DataFrame,
    features: Sequence[str] | None = None,
    label: str = schemas.LABEL,
    max_iter: int = 1000,
    patience: int = 50,
    max_depth: int = 5,
    step_size: float = 0.05,
    feature_subset: str = "all",
    subsampling: float = 1.0,
    seed: int = 42,
) -> PipelineModel:
    """Fit on split train, with as many of ``max_iter`` rounds as serve split val best.

    Rounds are fitted in growing numbers until the best one on the validation
    rows has ``patience`` rounds without gain after it; the model is then fitted
    with that many. The same seed gives the same first rounds, so the rounds
    that were judged are the ones in the model. Medians come from train rows only.
    """
    train = splits.where(F.col("split") == "train")
    names = usable_features(train, features or numeric_features(splits))
    as_double = [F.col(n).cast("double").alias(n) for n in names]
    imputer = Imputer(strategy="median", inputCols=names, outputCols=[f"{n}_filled" for n in names])
    filler = imputer.fit(train.select(*as_double))
    assembler = VectorAssembler(inputCols=imputer.getOutputCols(), outputCol="features")
    rows = splits.where(F.col("split").isin("train", "val")).select(
        *as_double, F.col(label).cast("double").alias(label), F.col("split").alias("split")
    )
    rows = assembler.transform(filler.transform(rows)).select("features", label, "split").persist()
    learn, judge = (rows.where(F.col("split") == part).select("features", label) for part in ("train", "val"))

    def fitted(rounds: int) -> GBTRegressionModel:
        booster = GBTRegressor(
            featuresCol="features",
            labelCol=label,
            predictionCol="y_hat_mw",
            maxIter=rounds,
            maxDepth=max_depth,
            stepSize=step_size,
            featureSubsetStrategy=feature_subset,
            subsamplingRate=subsampling,
            seed=seed,
        )
        return booster.fit(learn)

    try:
        rounds = min(max_iter, patience + 14)
        while True:
            model = fitted(rounds)
            best = best_round(model.evaluateEachIteration(judge, "squared"), patience)
            if best + patience <= rounds or rounds == max_iter:
                break
            rounds = min(max_iter, 2 * rounds)
        booster = model if best == rounds else fitted(best)
    finally:
        rows.unpersist()
    return PipelineModel(stages=[filler, assembler, booster])


def best_round(errors: Sequence[float], patience: int) -> int:
    """The number of rounds, from 1, with the least error before ``patience`` rounds bring no gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def model_features(model: PipelineModel) -> list[str]:
    """The features a model was fitted on, in order."""
    return list(model.stages[0].getInputCols())


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``y_hat_mw``; a missing feature column is an error."""
    names = model_features(model)
    missing = [n for n in names if n not in rows.columns]
    if missing:
        raise FeatureMismatchError(f"missing features: {', '.join(missing)}")
    scored = model.transform(rows.withColumns({n: F.col(n).cast("double") for n in names}))
    return scored.drop("features", *model.stages[0].getOutputCols())


def score_with(
    rows: DataFrame, features: Sequence[str], predict: Callable[[pd.DataFrame], Sequence[float]]
) -> DataFrame:
    """``rows`` with ``y_hat_mw`` from a foreign model, one call per Arrow batch on the executors."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(y_hat_mw=predict(frame[list(features)]))

    return rows.mapInPandas(batches, rows.withColumn("y_hat_mw", F.lit(0.0)).schema)


def batch_forecast(
    scored: DataFrame, model_name: str, model_run_id: str, created_at: Column, horizon_hours: int = HORIZON_HOURS
) -> DataFrame:
    """Forecast rows of scored features; ``event_ts_utc`` is the hour the features are from."""
    return scored.select(
        F.col("dt").alias("forecast_run_date"),
        F.date_add("dt", 1).alias("target_date"),
        "event_ts_utc",
        "series_id",
        "y_hat_mw",
        F.lit(model_name).alias("model_name"),
        F.lit(model_run_id).alias("model_run_id"),
        F.lit(horizon_hours).alias("horizon_hours"),
        created_at.alias("created_at_utc"),
    )


def evaluate(scored: DataFrame, label: str = schemas.LABEL, baseline: str | None = None) -> DataFrame:
    """RMSE, MAE and MAPE of scored rows in one row, with ``baseline_rmse`` of a column taken as a forecast."""
    y, p = F.col(label), F.col("y_hat_mw")
    measures = [
        accuracy.rmse(y, p).alias("rmse"), accuracy.mae(y, p).alias("mae"), accuracy.mape(y, p).alias("mape")
    ]
    if baseline is not None:
        measures.append(accuracy.rmse(y, F.col(baseline)).alias("baseline_rmse"))
    return scored.agg(*measures)


def run_record(run_id: str, run_date: date, features: Sequence[str], metrics: DataFrame) -> DataFrame:
    """One row for the table of runs."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).alias("run_date"),
        F.lit(len(features)).alias("n_features"),
        F.array_join(F.array(*[F.lit(f) for f in features]), ",").alias("feature_names"),
        *metrics.columns,
    )


def best_run(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """The run with the lowest metric; equal runs go by id."""
    return runs.where(F.col(metric).isNotNull()).orderBy(metric, "run_id").limit(1)


def last_approved_run(runs: DataFrame, approved: str = "approved") -> DataFrame:
    """The newest approved run, to roll back to; equal times go by id."""
    newest = F.max(F.struct("created_at", "run_id"))
    return runs.where(F.col("status") == approved).agg(newest.alias("_run")).select("_run.run_id", "_run.created_at")
