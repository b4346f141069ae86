"""Forecast metrics, drift, decisions and evaluation."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.catalog.frames import Frames, day_bounds, rounded, with_frames
from loadlake.catalog.registry import query
from loadlake.operators.asof import latest
from loadlake.plans import backtest, evaluation, monitoring, policy
from loadlake.sources import tables
from loadlake.streaming import intraday

_ACCURACY = ("mape", "mae", "rmse")
_ACCURACY_SQL = """round(avg(abs((load_mw - y_hat_mw) / nullif(load_mw, 0))) * 100, 6) AS mape,
  round(avg(abs(load_mw - y_hat_mw)), 6) AS mae, round(sqrt(avg((load_mw - y_hat_mw) ** 2)), 6) AS rmse,
  count(*) AS n, count(*) FILTER (WHERE load_mw IS NULL OR y_hat_mw IS NULL) AS n_null"""
_METRICS_SQL = f", metrics AS (SELECT target_date, series_id, {_ACCURACY_SQL} FROM pairs GROUP BY target_date, series_id)"

# Days of history and of the recent window; the test tables hold 30 days.
HISTORY, RECENT = 28, 7


def _pairs(f: Frames) -> DataFrame:
    return monitoring.forecast_vs_actual(f.forecasts, f.actuals)


def _candidate_pairs(f: Frames) -> DataFrame:
    return monitoring.forecast_vs_actual(f.candidates, f.actuals)


def _metrics(f: Frames) -> DataFrame:
    return monitoring.forecast_metrics(_pairs(f))


def _drift(f: Frames, by_series: bool = True) -> DataFrame:
    """Drift over the stored gold of the window, which is read more than once."""
    gold = f.gold(start=f.run_day - timedelta(days=HISTORY), end=f.run_day)
    features = gold.select("dt", "series_id", *monitoring.DRIFT_FEATURES)
    return monitoring.drift(
        tables.stored(features, "gold"), f.run_day, recent_days=RECENT, history_days=HISTORY, by_series=by_series
    )


def _psi_sql(samples: str, keys: str, day: str, features: dict[str, str]) -> str:
    """Oracle for PSI: quantile cuts, bin counts, index."""
    unpivoted = " UNION ALL ".join(
        f"SELECT {keys.replace('feature', chr(39) + name + chr(39) + ' AS feature')}, {expr} AS x, {day} >= d - {RECENT} AS recent"
        f" FROM {samples}, run WHERE {day} BETWEEN d - {HISTORY} AND d AND {expr} IS NOT NULL"
        for name, expr in features.items()
    )
    probs = ", ".join(str(i / 10) for i in range(11))
    inner = " + ".join(f"CAST(x >= c[{i}] AS INT)" for i in range(2, 11))
    return f""", v AS ({unpivoted}),
  cuts AS (SELECT {keys}, quantile_cont(x, [{probs}]) AS c FROM v WHERE NOT recent GROUP BY {keys}),
  sizes AS (SELECT {keys}, count(*) FILTER (WHERE NOT recent) AS n_baseline, count(*) FILTER (WHERE recent) AS n_recent FROM v GROUP BY {keys}),
  bins AS (SELECT {keys}, {inner} AS bin, count(*) FILTER (WHERE NOT recent) AS e, count(*) FILTER (WHERE recent) AS a
           FROM v JOIN cuts USING ({keys}) WHERE x BETWEEN c[1] AND c[11] GROUP BY {keys}, bin),
  psi AS (SELECT {keys}, sum((a / (n_recent + 1e-6) - e / (n_baseline + 1e-6))
                             * ln((a / (n_recent + 1e-6) + 1e-6) / (e / (n_baseline + 1e-6) + 1e-6))) AS psi, n_baseline, n_recent
          FROM bins JOIN sizes USING ({keys}) WHERE n_recent > 0 AND n_baseline > 0 GROUP BY {keys}, n_baseline, n_recent)"""


_GOLD_FEATURES = {"load_mw": "load_mw", "temperature_2m": "temperature_2m"}
_DRIFT_SQL = _psi_sql("gold_train", "series_id, feature", "dt", _GOLD_FEATURES)
_DRIFT_SELECT = "round(psi, 6) AS psi, n_baseline, n_recent, d AS eval_date, psi > 0.2 AS is_drift FROM psi, run"


@query(
    "forecast_vs_actual",
    with_frames("SELECT series_id, target_ts_utc, target_date, event_ts_utc, y_hat_mw, load_mw FROM pairs"),
)
def forecast_vs_actual(f):
    return _pairs(f).select("series_id", "target_ts_utc", "target_date", "event_ts_utc", "y_hat_mw", "load_mw")


@query(
    "forecast_vs_actual_reference",
    with_frames("""SELECT f.series_id, f.event_ts_utc AS target_ts_utc, f.target_date, f.y_hat_mw, a.load_mw
      FROM forecasts f JOIN actuals a ON a.series_id = f.series_id AND a.event_ts_utc = f.event_ts_utc"""),
)
def forecast_vs_actual_reference(f):
    pairs = monitoring.forecast_vs_actual(f.forecasts, f.actuals, "reference")
    return pairs.select("series_id", "target_ts_utc", "target_date", "y_hat_mw", "load_mw")


@query("forecast_metrics", with_frames(f"{_METRICS_SQL} SELECT *, 'seasonal_naive' AS model_name FROM metrics"))
def forecast_metrics(f):
    return rounded(_metrics(f), *_ACCURACY)


@query(
    "mape_over_time",
    with_frames(f"""{_METRICS_SQL} SELECT CAST(target_date AS TIMESTAMP) AS time, series_id, mape AS "MAPE_pct"
      FROM metrics, run WHERE target_date BETWEEN d - 14 AND d ORDER BY target_date"""),
)
def mape_over_time(f):
    start, end = F.lit(f.run_day - timedelta(days=14)), F.lit(f.run_day)
    series = monitoring.mape_over_time(_metrics(f), F.to_timestamp(start), F.to_timestamp(end))
    return rounded(series, "MAPE_pct")


@query(
    "forecast_series",
    with_frames("""SELECT target_ts_utc AS time, series_id, y_hat_mw AS forecast_mw FROM forecasts, run
      WHERE target_ts_utc BETWEEN CAST(d - 7 AS TIMESTAMP) AND CAST(d + 1 AS TIMESTAMP) ORDER BY target_ts_utc"""),
)
def forecast_series(f):
    day = f.run_day
    start, end = (F.to_timestamp(F.lit(d)) for d in (day - timedelta(days=7), day + timedelta(days=1)))
    rows = monitoring.in_time_range(f.forecasts, "target_ts_utc", start, end)
    return rows.select(F.col("target_ts_utc").alias("time"), "series_id", F.col("y_hat_mw").alias("forecast_mw"))


@query("drift_psi", with_frames(f"{_DRIFT_SQL} SELECT series_id, feature, {_DRIFT_SELECT}"))
def drift_psi(f):
    return rounded(_drift(f), "psi")


@query(
    "drift_psi_pooled",
    with_frames(f"{_psi_sql('gold_train', 'feature', 'dt', _GOLD_FEATURES)} SELECT feature, {_DRIFT_SELECT}"),
)
def drift_psi_pooled(f):
    """All series together, with quantiles that hold no group in one task."""
    return rounded(_drift(f, by_series=False), "psi")


@query(
    "residual_drift",
    with_frames(
        f"{_psi_sql('pairs', 'series_id, feature', 'target_date', {'residual': '(load_mw - y_hat_mw)'})} SELECT series_id, feature, {_DRIFT_SELECT}"
    ),
)
def residual_drift(f):
    pairs = tables.stored(_pairs(f).select("series_id", "target_date", "load_mw", "y_hat_mw"), "pairs")
    found = monitoring.residual_drift(pairs, f.run_day, RECENT, HISTORY)
    return rounded(found, "psi")


@query(
    "metrics_lookback",
    with_frames(f"""{_METRICS_SQL} SELECT m.*, 'seasonal_naive' AS model_name FROM metrics m, run WHERE target_date BETWEEN d - 7 AND d ORDER BY target_date DESC"""),
)
def metrics_lookback(f):
    day = f.run_day
    rows = tables.lookback(_metrics(f), "target_date", day - timedelta(days=7), day)
    return rounded(rows, *_ACCURACY)


@query(
    "retrain_decision",
    with_frames(f"""{_METRICS_SQL} {_DRIFT_SQL},
      m AS (SELECT max(mape) AS max_mape FROM metrics, run WHERE target_date BETWEEN d - 7 AND d),
      p AS (SELECT bool_or(psi > 0.2) AS drifted FROM psi)
      SELECT round(max_mape, 6) AS max_mape, coalesce(max_mape > 6.0, false) AS metrics_bad, coalesce(drifted, false) AS drift_bad,
        coalesce(max_mape > 6.0, false) OR coalesce(drifted, false) AS retrain FROM m, p"""),
)
def retrain_decision(f):
    decision = policy.retrain_decision(_metrics(f), _drift(f), f.run_day)
    return rounded(decision, "max_mape")


@query(
    "pinball",
    with_frames("""SELECT series_id, """
                + ", ".join(
                    f"round(avg(greatest({q} * (load_mw - y_hat_mw), ({q} - 1) * (load_mw - y_hat_mw))), 6) AS pinball_p{round(q * 100)}"
                    for q in evaluation.QUANTILES
                )
                + " FROM pairs GROUP BY series_id"),
)
def pinball(f):
    losses = evaluation.pinball(_pairs(f), ["series_id"])
    return rounded(losses, "pinball_p10", "pinball_p50", "pinball_p90")


@query(
    "smape",
    with_frames("""SELECT series_id, target_date,
      round(avg(2 * abs(load_mw - y_hat_mw) / nullif(abs(load_mw) + abs(y_hat_mw), 0)) * 100, 6) AS smape
      FROM pairs GROUP BY series_id, target_date"""),
)
def smape(f):
    return rounded(evaluation.smape(_pairs(f), ["series_id", "target_date"]), "smape")


@query(
    "rolling_origin",
    with_frames(""", bounds AS (SELECT min(dt) + 1 AS a, max(dt) AS b FROM demand),
      origins AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 2 DAY)) AS DATE) AS origin FROM bounds)
      SELECT t.series_id, origin, CAST(t.dt - origin + 1 AS INT) AS horizon_day,
        round(avg(abs(t.load_mw - k.load_mw)), 6) AS mae, round(sqrt(avg((t.load_mw - k.load_mw) ** 2)), 6) AS rmse, count(*) AS n,
        max(k.event_ts_utc) AS last_known_ts
      FROM actuals t JOIN origins ON t.dt BETWEEN origin AND origin + 2
      JOIN actuals k ON k.series_id = t.series_id AND k.event_ts_utc = t.event_ts_utc - to_days(CAST(t.dt - origin + 1 AS INT))
      GROUP BY ALL"""),
)
def rolling_origin(f):
    first, last = F.lit(f.first_day + timedelta(days=1)), F.lit(f.last_day)
    backtest = evaluation.rolling_origin(f.demand, first, last, step_days=2, horizon_days=3)
    return rounded(backtest, "mae", "rmse")


def _refit_sql(horizon_days: int, step_days: int, min_rows: int) -> str:
    """A line through two inputs per series, horizon and origin, from moments of all rows known before it."""
    moments = ", ".join(f"sum({p}) AS {n}" for n, p in {
        "s1": "x1 - 0.0", "s2": "x2 - 0.0", "sy": "y - 0.0", "s11": "x1 * x1", "s12": "x1 * x2", "s22": "x2 * x2", "s1y": "x1 * y", "s2y": "x2 * y",
    }.items())
    return f""", samples AS (
        SELECT t.series_id, t.dt, h AS horizon_day, t.load_mw AS y, k.load_mw AS x1, w.load_mw AS x2
        FROM actuals t CROSS JOIN (SELECT CAST(unnest(range(1, {horizon_days + 1})) AS INT) AS h)
        JOIN actuals k ON k.series_id = t.series_id AND k.event_ts_utc = t.event_ts_utc - to_days(h)
        JOIN actuals w ON w.series_id = t.series_id AND w.event_ts_utc = t.event_ts_utc - to_days(7)),
      bounds AS (SELECT min(dt) + 14 AS a, max(dt) AS b FROM demand),
      origins AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL {step_days} DAY)) AS DATE) AS origin FROM bounds),
      known AS (
        SELECT series_id, horizon_day, origin, count(*)::DOUBLE AS n, {moments}
        FROM samples JOIN origins ON dt < origin GROUP BY ALL HAVING count(*) >= {min_rows}),
      centred AS (
        SELECT *, s11 - s1 * s1 / n AS c11, s12 - s1 * s2 / n AS c12, s22 - s2 * s2 / n AS c22, s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM known),
      slopes AS (
        SELECT *, (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS b1, (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) AS b2 FROM centred),
      lines AS (SELECT *, (sy - b1 * s1 - b2 * s2) / n AS b0 FROM slopes)
      SELECT l.series_id, origin, l.horizon_day, CAST(l.n AS BIGINT) AS n_train, round(b0, 6) AS intercept, round(b1, 6) AS recent, round(b2, 6) AS week,
        round(avg(abs(y - b0 - b1 * x1 - b2 * x2)), 6) AS mae, round(sqrt(avg((y - b0 - b1 * x1 - b2 * x2) ** 2)), 6) AS rmse, count(*) AS n
      FROM lines l JOIN samples s ON s.series_id = l.series_id AND s.horizon_day = l.horizon_day AND s.dt = l.origin + l.horizon_day - 1
      GROUP BY ALL"""


@query("rolling_origin_refit", with_frames(_refit_sql(3, 2, 24)))
def rolling_origin_refit(f):
    first, last = f.first_day + timedelta(days=14), f.last_day
    rows = backtest.refitted_backtest(f.demand, first, last, step_days=2, horizon_days=3, min_rows=24)
    return rounded(rows, "intercept", "recent", "week", "mae", "rmse")


@query(
    "segment_metrics",
    with_frames(f""", segmented AS (
        SELECT p.*, hour(target_ts_utc) >= 8 AND hour(target_ts_utc) < 20 AS is_peak, c.is_working_day, c.is_holiday,
          CASE WHEN month(target_date) IN (12,1,2) THEN 'winter' WHEN month(target_date) IN (3,4,5) THEN 'spring'
               WHEN month(target_date) IN (6,7,8) THEN 'summer' ELSE 'autumn' END AS season
        FROM pairs p LEFT JOIN calendar c ON c.dt = p.target_date)
      SELECT is_peak, season, is_working_day, is_holiday, {_ACCURACY_SQL} FROM segmented
      GROUP BY GROUPING SETS ((is_peak), (season), (is_working_day), (is_holiday), ())"""),
)
def segment_metrics(f):
    return rounded(evaluation.segment_metrics(_pairs(f), f.calendar), *_ACCURACY)


@query(
    "horizon_metrics",
    with_frames(f"SELECT series_id, horizon_hours, {_ACCURACY_SQL} FROM pairs GROUP BY series_id, horizon_hours"),
)
def horizon_metrics(f):
    return rounded(evaluation.horizon_metrics(_pairs(f)), *_ACCURACY)


_VOLUME_SQL = """days AS (SELECT CAST(unnest(generate_series(date_trunc('day', min({ts})), date_trunc('day', max({ts})), INTERVAL 1 DAY)) AS DATE) AS dt FROM {table}),
  n AS (SELECT d.dt, s.k, coalesce(c.n_rows, 0) AS n_rows FROM days d CROSS JOIN (SELECT DISTINCT {key} AS k FROM {table}) s
        LEFT JOIN (SELECT {key} AS k, CAST({ts} AS DATE) AS dt, count(*) AS n_rows FROM {table} GROUP BY ALL) c ON c.k = s.k AND c.dt = d.dt),
  w AS (SELECT *, avg(n_rows) OVER b AS m, stddev_samp(n_rows) OVER b AS s FROM n
        WINDOW b AS (PARTITION BY k ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  SELECT k AS {name}, dt, n_rows, round(m, 6) AS mean_before, round(s, 6) AS std_before,
    coalesce(abs(n_rows - m) > 3 * s, false) AS is_anomaly FROM w"""


def _volume_anomaly(rows: DataFrame, key: str, ts: str) -> DataFrame:
    counts = tables.stored(monitoring.daily_volume(rows, [key], ts), "volume")
    volume = monitoring.fill_days(counts, [key], *map(F.lit, day_bounds(counts, "dt")))
    return rounded(monitoring.volume_anomaly(volume, [key]), "mean_before", "std_before")


@query(
    "volume_anomaly",
    "WITH " + _VOLUME_SQL.format(table="events", ts="ts", key="event_type", name="event_type"),
)
def volume_anomaly(f):
    return _volume_anomaly(f.events, "event_type", "ts")


@query(
    "volume_anomaly_lineitem",
    "WITH " + _VOLUME_SQL.format(table="lineitem", ts="l_shipdate", key="l_returnflag", name="l_returnflag"),
)
def volume_anomaly_lineitem(f):
    return _volume_anomaly(f.lineitem, "l_returnflag", "l_shipdate")


@query(
    "baseline_degradation",
    with_frames(""", compared AS (SELECT c.series_id, c.load_mw - c.y_hat_mw AS e, c.load_mw - b.y_hat_mw AS eb
        FROM candidate_pairs c JOIN pairs b ON b.series_id = c.series_id AND b.target_ts_utc = c.target_ts_utc),
      loss AS (SELECT series_id, avg(greatest(0.5 * e, -0.5 * e)) AS p, avg(greatest(0.5 * eb, -0.5 * eb)) AS pb FROM compared GROUP BY series_id)
      SELECT series_id, round(p, 6) AS pinball, round(pb, 6) AS pinball_baseline, round(p / nullif(pb, 0) - 1, 6) AS degradation FROM loss"""),
)
def baseline_degradation(f):
    compared = evaluation.baseline_degradation(_candidate_pairs(f), _pairs(f))
    return rounded(compared, "pinball", "pinball_baseline", "degradation")


@query(
    "shadow_compare",
    with_frames(""", compared AS (SELECT c.series_id, b.load_mw - b.y_hat_mw AS e, c.load_mw - c.y_hat_mw AS ec
        FROM candidate_pairs c JOIN pairs b ON b.series_id = c.series_id AND b.target_ts_utc = c.target_ts_utc)
      SELECT series_id, round(avg(abs(e)), 6) AS mae_current, round(avg(abs(ec)), 6) AS mae_candidate,
        round(sqrt(avg(e * e)), 6) AS rmse_current, round(sqrt(avg(ec * ec)), 6) AS rmse_candidate, count(*) AS n,
        sqrt(avg(ec * ec)) < sqrt(avg(e * e)) AS candidate_better
      FROM compared GROUP BY series_id"""),
)
def shadow_compare(f):
    pairs = _pairs(f).unionByName(_candidate_pairs(f))
    compared = evaluation.shadow_compare(pairs, "seasonal_naive", "weekly_naive")
    return rounded(compared, "mae_current", "mae_candidate", "rmse_current", "rmse_candidate")


@query(
    "last_known_good",
    with_frames(""", wanted AS (SELECT series_id, event_ts_utc + INTERVAL 24 HOUR AS target_ts_utc FROM demand)
      SELECT w.series_id, w.target_ts_utc, f.target_ts_utc AS known_ts_utc, f.y_hat_mw, f.target_ts_utc < w.target_ts_utc AS is_fallback
      FROM wanted w ASOF LEFT JOIN forecasts f ON w.series_id = f.series_id AND w.target_ts_utc >= f.target_ts_utc"""),
)
def last_known_good(f):
    """Every hour of the next days wants a forecast; hours without load have none of their own."""
    wanted = f.demand.select("series_id", evaluation.shifted("event_ts_utc", 86_400).alias("target_ts_utc"))
    return policy.last_known_good(wanted, f.forecasts)


@query(
    "residual_quantiles",
    with_frames(""", r AS (
        SELECT *, quantile_cont(load_mw - y_hat_mw, [0.1, 0.5, 0.9]) OVER w AS q, count(*) OVER w AS n_residuals FROM pairs
        WINDOW w AS (PARTITION BY series_id, hour(target_ts_utc) ORDER BY target_ts_utc
                     RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 86401 SECOND PRECEDING))
      SELECT series_id, target_ts_utc, target_date, load_mw, y_hat_mw, n_residuals,
        round(y_hat_mw + q[1], 6) AS y_hat_p10, round(y_hat_mw + q[2], 6) AS y_hat_p50, round(y_hat_mw + q[3], 6) AS y_hat_p90
      FROM r WHERE n_residuals > 0"""),
)
def residual_quantiles(f):
    intervals = evaluation.residual_intervals(_pairs(f))
    return rounded(intervals, "y_hat_p10", "y_hat_p50", "y_hat_p90")


@query(
    "alert_rows",
    with_frames(f"""{_METRICS_SQL} {_DRIFT_SQL},
      seen AS (SELECT event_type, max(ts) AS last_ts FROM events GROUP BY event_type),
      m AS (SELECT 'mape' AS measure, series_id AS subject, target_date AS day, mape AS value, 6.0 AS threshold FROM metrics
        UNION ALL SELECT 'psi ' || feature, series_id, d, psi, 0.2 FROM psi, run
        UNION ALL SELECT 'age_seconds', event_type, d + 1,
          CAST(floor(epoch(CAST(d + 2 AS TIMESTAMP))) - floor(epoch(last_ts)) AS DOUBLE), 120.0 FROM seen, run)
      SELECT measure, subject, day, round(value, 6) AS value, CAST(threshold AS DOUBLE) AS threshold FROM m WHERE value > threshold"""),
)
def alert_rows(f):
    day = f.run_day
    now = F.to_timestamp(F.lit(day + timedelta(days=2)))
    fresh = monitoring.freshness(f.events, "event_type", "ts", now, 120)
    measures = [
        policy.readings(_metrics(f), "mape", F.col("series_id"), F.col("target_date"), F.col("mape"), 6.0),
        policy.readings(
            _drift(f), F.concat_ws(" ", F.lit("psi"), "feature"), F.col("series_id"), F.col("eval_date"), F.col("psi"), 0.2
        ),
        policy.readings(
            fresh, "age_seconds", F.col("source"), F.lit(day + timedelta(days=1)), F.col("age_seconds"), 120
        ),
    ]
    return rounded(policy.alert_rows(measures), "value")


@query(
    "freshness",
    """WITH now AS (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY AS t FROM events),
       seen AS (SELECT event_type AS source, max(ts) AS last_ts FROM events GROUP BY event_type)
       SELECT source, last_ts, CAST(floor(epoch(t)) - floor(epoch(last_ts)) AS BIGINT) AS age_seconds,
         floor(epoch(t)) - floor(epoch(last_ts)) <= 3600 AS is_fresh FROM seen, now""",
)
def freshness(f):
    now = F.to_timestamp(F.lit(f.run_day + timedelta(days=2)))
    return monitoring.freshness(f.events, "event_type", "ts", now, 3600)


@query(
    "run_success_7d",
    """WITH now AS (SELECT max(o_orderdate) AS t FROM orders)
       SELECT count(*) AS n_success, count(*) >= 7 AS is_green FROM orders, now
       WHERE o_orderstatus = 'F' AND o_orderdate > t - INTERVAL 7 DAY AND o_orderdate <= t""",
)
def run_success_7d(f):
    now = F.lit(f.orders.agg(F.max("o_orderdate")).first()[0])
    return monitoring.successful_runs(f.runs, now, success="approved")


_QUARTERS_SQL = """, observed AS (
    SELECT event_type AS series_id, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, avg(value) AS value FROM events GROUP BY ALL
  ), steps AS (
    SELECT series_id, unnest(generate_series(target_ts_utc, target_ts_utc + INTERVAL 45 MINUTE, INTERVAL 15 MINUTE)) AS ts, y_hat_mw AS baseline
    FROM forecasts
  )"""


@query(
    "intraday_correction",
    with_frames(f"""{_QUARTERS_SQL}, residuals AS (
        SELECT o.series_id, o.ts + INTERVAL 15 MINUTE AS ts, o.value - s.baseline AS residual
        FROM observed o JOIN steps s ON s.series_id = o.series_id AND s.ts = o.ts)
      SELECT s.series_id, s.ts, s.baseline, round(residual, 6) AS residual, round(baseline + coalesce(residual, 0), 6) AS corrected
      FROM steps s LEFT JOIN residuals r ON r.series_id = s.series_id AND r.ts = s.ts"""),
)
def intraday_correction(f):
    observed = intraday.rebin(f.events, "event_type", "ts", "value")
    return rounded(intraday.correct_baseline(f.forecasts, observed), "residual", "corrected")


@query(
    "intraday_cycle",
    with_frames(f"""{_QUARTERS_SQL}, newest AS (
        SELECT series_id, ts, value FROM observed QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) = 1
      ), ahead AS (
        SELECT n.*, k AS step, ts + k * INTERVAL 15 MINUTE AS target_ts_utc FROM newest n, range(0, 25) r(k)
      ), j AS (
        SELECT a.*, f.y_hat_mw AS baseline FROM ahead a
        LEFT JOIN forecasts f ON f.series_id = a.series_id AND f.target_ts_utc = date_trunc('hour', a.target_ts_utc)
      ), r AS (SELECT *, max(CASE WHEN step = 0 THEN value - baseline END) OVER (PARTITION BY series_id) AS residual FROM j)
      SELECT series_id, ts AS origin_ts_utc, CAST(step AS INT) AS step, target_ts_utc,
        round(coalesce(baseline + coalesce(residual, 0), value), 6) AS y_hat FROM r WHERE step > 0"""),
)
def intraday_cycle(f):
    """A cycle at the end of the data: 24 steps for every series."""
    observed = intraday.rebin(f.events, "event_type", "ts", "value")
    newest = latest(observed, ["series_id"], "ts")
    return rounded(intraday.intraday_cycle(newest, f.forecasts), "y_hat")
