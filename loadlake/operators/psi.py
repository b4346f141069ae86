"""Population stability index of a recent sample against a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.operators.quantiles import quantiles, small_group_quantiles
from loadlake.sources.tables import stored

# Fixed values of the index.
BINS = 10
EPSILON = 1e-6
DRIFT_THRESHOLD = 0.2


def bin_of(value: Column, cuts: Column, bins: int = BINS) -> Column:
    """Bin of ``value`` among ``bins + 1`` ascending cuts: half-open, last one closed, NULL outside."""
    edges = [F.get(cuts, F.lit(i)) for i in range(bins + 1)]
    inner = sum((F.when(e <= value, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when(value.between(edges[0], edges[-1]), inner)


def psi(
    samples: DataFrame, keys: Sequence[str], value: str, is_recent: str, bins: int = BINS, pooled: bool = False
) -> DataFrame:
    """Index per key with the sizes of both samples; keys lacking one sample are left out.

    ``pooled`` is for keys whose samples may exceed one task: the cut points
    are written, so that their size decides how they meet the samples, and no
    key is gathered. The counts per bin are reduced before the shuffle either
    way. ``samples`` is read more than once.
    """
    rows = samples.where(F.col(value).isNotNull() & ~F.isnan(value)).select(
        *keys, F.col(value).alias("_v"), F.col(is_recent).alias("_recent")
    )
    probs = [i / bins for i in range(bins + 1)]
    baseline = rows.where(~F.col("_recent"))
    if pooled:
        cut_points = stored(quantiles(baseline, keys, "_v", probs), "cut-points")
    else:
        cut_points = small_group_quantiles(baseline, keys, "_v", probs)
    counts = (
        rows.join(cut_points, list(keys))
        .groupBy(*keys, bin_of(F.col("_v"), F.col("quantiles"), bins).alias("_bin"))
        .agg(F.count_if(~F.col("_recent")).alias("_e"), F.count_if("_recent").alias("_a"))
    )
    totals = counts.groupBy(*keys).agg(
        F.sum("_e").alias("n_baseline"),
        F.sum("_a").alias("n_recent"),
        F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct("_bin", "_e", "_a"))).alias("_bins"),
    )

    def term(b: Column) -> Column:
        expected = b["_e"] / (F.col("n_baseline") + EPSILON)
        actual = b["_a"] / (F.col("n_recent") + EPSILON)
        return (actual - expected) * F.log((actual + EPSILON) / (expected + EPSILON))

    index = F.aggregate(F.array_sort("_bins"), F.lit(0.0), lambda acc, b: acc + term(b))
    return totals.where((F.col("n_recent") > 0) & (F.col("n_baseline") > 0)).select(
        *keys, index.alias("psi"), "n_baseline", "n_recent"
    )
