"""Forecast quantiles by linear quantile regression: reweighted normal equations, summed by Spark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.plans.evaluation import QUANTILES, quantile_name
from loadlake.sources.tables import stored

#: A residual counts as this share of the label's deviation at least, first and in the end; below it the loss is a parabola.
SOFT_FIRST, SOFT_LAST = 0.3, 0.002
#: Added to the diagonal, as a share of the rows, so that features that say the same do no harm.
RIDGE = 1e-9


@dataclass(frozen=True)
class QuantileModel:
    """One linear model per quantile over standardised features; ``weights`` has the intercept first."""

    features: tuple[str, ...]
    quantiles: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]
    rounds: int

    def inputs(self) -> list[Column]:
        columns = [F.col(n).cast("double") for n in self.features]
        return [F.lit(1.0)] + [
            (F.when(F.isnan(c), None).otherwise(c) - m) / s for c, m, s in zip(columns, self.means, self.scales, strict=True)
        ]

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with y_hat_p10 and so on; quantiles that would cross are put in order. NULL where a feature is NULL."""
        x = self.inputs()
        lines = F.array(*[sum((F.lit(w) * c for w, c in zip(ws[1:], x[1:], strict=True)), F.lit(ws[0])) for ws in self.weights])
        whole = F.forall(lines, lambda y: y.isNotNull())
        ordered = df.withColumn("_ordered", F.when(whole, F.array_sort(lines)))
        places = {quantile_name("y_hat", q): F.col("_ordered")[i] for i, q in enumerate(self.quantiles)}
        return ordered.withColumns(places).drop("_ordered")


def fit_quantiles(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    quantiles: Sequence[float] = QUANTILES,
    max_rounds: int = 40,
    tolerance: float = 5e-4,
) -> QuantileModel:
    """Linear models of ``quantiles`` of ``label``, the least pinball loss over all ``rows``.

    A residual r costs abs(r) / 2 + (q - 1/2) * r. Under a square through the
    residuals of the lines so far, abs(r) is r * r over their size, so the
    least cost is a weighted least-squares line with a constant pull to one
    side. Each round sums the normal equations of all quantiles in one scan
    and solves them on the driver: numbers that depend on the features and
    quantiles only. Residuals close to zero count as ``SOFT_FIRST`` down to
    ``SOFT_LAST`` of the label's deviation. It ends when no weight moves by
    more than ``tolerance`` deviations, or after ``max_rounds``.

    Rows with a NULL or NaN feature or label are left out. A feature that never
    changes has weight 0. Without rows there is nothing to fit: ``ValueError``.
    """
    quantiles = tuple(sorted(quantiles))
    numbers = [F.col(n).cast("double").alias(n) for n in (*features, label)]
    usable = stored(rows.select(*numbers).dropna(), "quantile-rows")
    stats = usable.agg(*[x for n in (*features, label) for x in (F.avg(n), F.stddev_pop(n))], F.count("*")).first()
    if not stats[-1]:
        raise ValueError("no rows with all features and the label")
    means = tuple(stats[2 * i] for i in range(len(features)))
    scales = tuple(stats[2 * i + 1] or 1.0 for i in range(len(features)))
    centre, spread = stats[2 * len(features)], stats[2 * len(features) + 1] or 1.0
    x = QuantileModel(tuple(features), quantiles, means, scales, (), 0).inputs()
    y = (F.col(label) - centre) / spread
    table = stored(usable.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], y.alias("y")), "quantile-inputs")
    weights = np.zeros((len(quantiles), len(x)))
    soft, done = SOFT_FIRST, 0
    for done in range(1, max_rounds + 1):
        new = np.array([_solved(row) for row in _equations(table, quantiles, weights, soft, len(x))])
        moved = np.abs(new - weights).max()
        weights = new
        if moved < tolerance and soft <= SOFT_LAST:
            break
        soft = max(SOFT_LAST, soft / 2)
    weights *= spread
    weights[:, 0] += centre
    return QuantileModel(tuple(features), quantiles, means, scales, tuple(map(tuple, weights.tolist())), done)


def _equations(table: DataFrame, quantiles: Sequence[float], weights: np.ndarray, soft: float, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The normal equations of each quantile, in one scan."""
    sums, rows = [], table
    for k, q in enumerate(quantiles):
        line = sum((F.lit(float(w)) * F.col(f"x{i}") for i, w in enumerate(weights[k])), F.lit(0.0))
        rows = rows.withColumn(f"r{k}", F.col("y") - line)
        rows = rows.withColumn(f"w{k}", 1 / F.greatest(F.abs(f"r{k}"), F.lit(soft)))
        sums += [F.sum(F.col(f"w{k}") * F.col(f"x{i}") * F.col(f"x{j}")) for i in range(n) for j in range(i, n)]
        sums += [F.sum((F.col(f"w{k}") * F.col("y") + F.lit(2 * q - 1)) * F.col(f"x{i}")) for i in range(n)]
    found = list(rows.agg(*sums).first())
    size, out = n * (n + 1) // 2 + n, []
    for k in range(len(quantiles)):
        part = found[k * size : (k + 1) * size]
        left = np.zeros((n, n))
        left[np.triu_indices(n)] = part[: n * (n + 1) // 2]
        out.append((left + np.triu(left, 1).T, np.array(part[n * (n + 1) // 2 :])))
    return out


def _solved(equations: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    left, right = equations
    return np.linalg.solve(left + RIDGE * left[0, 0] * np.eye(len(left)), right)


def coverage(df: DataFrame, label: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The share of rows below each quantile and between the outer ones, their pinball losses, and how often neighbours cross."""
    y = F.col(label)
    names = [quantile_name("y_hat", q) for q in sorted(quantiles)]
    known = df.where(y.isNotNull() & F.col(names[0]).isNotNull())
    shares = [F.avg((y <= F.col(n)).cast("double")).alias(f"below_{n}") for n in names]
    crossed = F.greatest(F.lit(0), *[(F.col(a) > F.col(b)).cast("int") for a, b in zip(names, names[1:], strict=False)])
    losses = [
        F.avg(F.greatest(q * (y - F.col(n)), (q - 1) * (y - F.col(n)))).alias(f"pinball_{n}") for q, n in zip(sorted(quantiles), names, strict=True)
    ]
    inside = F.avg(y.between(F.col(names[0]), F.col(names[-1])).cast("double")).alias("inside")
    return known.agg(F.count("*").alias("n"), *shares, inside, *losses, F.coalesce(F.sum(crossed), F.lit(0)).alias("crossings"))
