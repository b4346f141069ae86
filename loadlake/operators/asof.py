"""Point-in-time join and latest row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.timefns import DAY
from loadlake.operators.blocks import BLOCK, block_of, same_keys


def asof_join(
    left: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    feature_ts: str,
    ttl_seconds: int | None = None,
    strict: bool = False,
    block_seconds: int = DAY,
    rows_per_part: int = 100_000,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Each row of ``left`` with the newest ``features`` row of its key at or before its time.

    ``strict`` leaves out a feature row of the very same time. A feature row
    older than ``ttl_seconds`` is not used. The feature columns, ``feature_ts``
    among them, are NULL without a match.

    Keys are cut into time blocks, and a block starts from the newest feature
    row before it, found over one summary row per (key, block). The rows of
    ``left`` in a block do not depend on each other: where there are more than
    ``rows_per_part`` of them, they are dealt over as many parts as it takes,
    and only there the block's features are copied to each part. The counts come
    from ``left`` itself, so no key or moment fills one task. Of several feature
    rows of one time the one largest in ``tie_break`` counts.
    """
    values = [c for c in features.columns if c not in keys]
    packed = features.dropna(subset=[*keys, feature_ts]).select(
        *keys, block_of(F.col(feature_ts), block_seconds).alias(BLOCK), F.struct(*values).alias("_feature")
    )
    order = [F.col(f"_feature.{c}") for c in (feature_ts, *tie_break)]
    newest = packed.groupBy(*keys, BLOCK).agg(F.max_by("_feature", F.struct(*order)).alias("_feature"))
    blocked = left.withColumn(BLOCK, block_of(F.col(left_ts), block_seconds))
    counts = blocked.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    if ttl_seconds is None:
        # With the count in the condition both uses read one shuffle.
        carried = _carried_to(newest, counts.where(F.col("_n") > 0).select(*keys, BLOCK), keys)
    else:
        carried = _carried_ahead(newest, keys, -(-ttl_seconds // block_seconds))

    # At most one row for rows_per_part rows of left; a join by shuffle would move both tables once more for it.
    crowded = counts.where(F.col("_n") > rows_per_part)
    crowded = F.broadcast(crowded.select(*keys, BLOCK, F.ceil(F.col("_n") / rows_per_part).cast("int").alias("_parts")))

    def with_parts(df: DataFrame) -> DataFrame:
        met = df.alias("l").join(crowded.alias("r"), same_keys("l", "r", [*keys, BLOCK]), "left")
        return met.select("l.*", F.coalesce("r._parts", F.lit(1)).alias("_parts"))

    sources = with_parts(packed.unionByName(carried)).select(
        *keys,
        BLOCK,
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"),
        "_feature",
        F.col(f"_feature.{feature_ts}").alias("_at"),
        F.lit(1 if strict else 0).alias("_kind"),
    )
    asked = with_parts(blocked).select(
        *keys,
        BLOCK,
        F.pmod(F.xxhash64(*left.columns), F.col("_parts")).cast("int").alias("_part"),
        F.struct(*[c for c in left.columns if c not in keys]).alias("_left"),
        F.col(left_ts).alias("_at"),
        F.lit(0 if strict else 1).alias("_kind"),
    )
    so_far = (
        Window.partitionBy(*keys, BLOCK, "_part")
        .orderBy("_at", "_kind", *[F.col(f"_feature.{c}") for c in tie_break])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        asked.unionByName(sources, allowMissingColumns=True)
        .withColumn("_feature", F.last("_feature", ignorenulls=True).over(so_far))
        .where(F.col("_left").isNotNull())
    )
    if ttl_seconds is not None:
        age = F.unix_micros("_at") - F.unix_micros(F.col(f"_feature.{feature_ts}"))
        matched = matched.withColumn("_feature", F.when(age <= ttl_seconds * 1_000_000, F.col("_feature")))
    return matched.select(*keys, "_left.*", "_feature.*")


def _carried_to(newest: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each of ``blocks``, the feature row newest before it."""
    summary = newest.unionByName(blocks, allowMissingColumns=True).groupBy(*keys, BLOCK).agg(
        F.first("_feature", ignorenulls=True).alias("_feature"), F.bool_or(F.col("_feature").isNull()).alias("_wanted")
    )
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        summary.withColumn("_feature", F.last("_feature", ignorenulls=True).over(earlier))
        .where(F.col("_wanted") & F.col("_feature").isNotNull())
        .drop("_wanted")
    )


def _carried_ahead(newest: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    """Each block's newest feature row in the blocks after it, up to the next one with features or ``reach`` blocks."""
    following = F.lead(BLOCK).over(Window.partitionBy(*keys).orderBy(BLOCK))
    last = F.least(following, F.col(BLOCK) + reach)
    ahead = newest.withColumn("_last", last)
    return ahead.select(*keys, F.explode(F.sequence(F.col(BLOCK) + 1, F.col("_last"))).alias(BLOCK), "_feature")


def latest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per key, reduced before the shuffle."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(ts)).alias("_row")).select(*keys, "_row.*")
