"""Exact quantiles with linear interpolation, also for groups larger than a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.sources.tables import stored

# percentile_approx keeps ranks within n / ACCURACY, so edges SLACK apart on
# either side of a probability hold few rows between them. Edges only decide
# how many rows are ranked, never the result.
ACCURACY = 50_000
SLACK = 4 / ACCURACY


def small_group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """For groups bounded by their key, such as the hours of one series in a window of days."""
    return df.groupBy(*keys).agg(F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles"))


def cell_of(value: Column, edges: Column, n: int) -> Column:
    """The place of ``value`` among ``n`` ascending edges: odd on an edge, even between two; it never falls as ``value`` grows."""
    at = [F.get(edges, F.lit(i)) for i in range(n)]
    steps = [F.when(value > e, 2).when(value == e, 1).otherwise(0) for e in at]
    return sum(steps[1:], steps[0])


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """For groups of any size: ``keys`` and the array ``quantiles``.

    A sketch gives two edges around each probability, and the edges cut a
    group's values into cells. The rows of every cell are counted, which tells
    exactly in which cells the wanted order statistics lie, and only the rows
    of those cells are ranked, a cell per task, with equal values counted once
    before the shuffle. That is right wherever the edges lie, for groups of any
    size; the better the sketch, the fewer rows are ranked. An edge is a cell of
    its own, so a value that very many rows share is one row of a cell.

    Edges and wanted cells are a row for each group or cell and are written, so
    their size is known when they meet the rows, and a sketch that is computed
    again cannot mix with older counts. ``df`` is read three times. Rows with a
    NULL value or key are left out; a group without values has no row.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    wanted_probs = [x for p in probs for x in (max(0.0, p - SLACK), min(1.0, p + SLACK))]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(x) for x in wanted_probs]), ACCURACY)
    edges = stored(rows.groupBy(*keys).agg(F.array_sort(sketch).alias("_edges")), "quantile-edges")
    cell = cell_of(F.col("_v"), F.col("_edges"), len(wanted_probs)).alias("_cell")

    counted = rows.join(edges, keys).select(*keys, "_edges", cell).groupBy(*keys, "_edges", "_cell").agg(F.count(F.lit(1)).alias("_in"))
    group = Window.partitionBy(*keys)
    up_to = F.sum("_in").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumns({"_n": F.sum("_in").over(group), "_before": up_to - F.col("_in")})

    def asked(i: int, p: float, side: str) -> Column:
        position = F.lit(float(p)) * (F.col("_n") - 1)
        rank = (F.floor(position) if side == "lower" else F.ceil(position)) + 1
        return F.struct(F.lit(i).alias("probe"), F.lit(side).alias("side"), rank.alias("rank"), (position - F.floor(position)).alias("fraction"))

    asks = F.array(*[asked(i, p, side) for i, p in enumerate(probs) for side in ("lower", "upper")])
    here = F.filter(asks, lambda a: (a["rank"] > F.col("_before")) & (a["rank"] <= F.col("_before") + F.col("_in")))
    cells = placed.withColumn("_asks", here).where(F.size("_asks") > 0)
    cells = stored(cells.select(*keys, "_edges", "_cell", "_before", "_asks"), "quantile-cells")

    held = cells.groupBy(*keys, "_edges").agg(F.collect_set("_cell").alias("_cells"))
    inside = rows.join(held, keys).withColumn("_cell", cell).where(F.array_contains("_cells", F.col("_cell")))
    values = inside.groupBy(*keys, "_cell", "_v").agg(F.count(F.lit(1)).alias("_c"))
    in_order = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("_to", F.sum("_c").over(in_order)).join(cells.drop("_edges"), [*keys, "_cell"])
    first = F.col("_before") + F.col("_to") - F.col("_c")
    hit = F.filter("_asks", lambda a: (a["rank"] > first) & (a["rank"] <= F.col("_before") + F.col("_to")))
    found = ranked.select(*keys, "_v", F.explode(hit).alias("_ask"))

    def picked(side: str) -> Column:
        return F.max(F.when(F.col("_ask.side") == side, F.col("_v")))

    lower, upper = picked("lower"), picked("upper")
    each = found.groupBy(*keys, F.col("_ask.probe").alias("_probe")).agg((lower + F.max("_ask.fraction") * (upper - lower)).alias("_q"))
    return each.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_probe", "_q"))), lambda s: s["_q"]).alias("quantiles")
    )
