"""Sequence samples, time index and feature contract for models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake import schemas
from loadlake.functions.timefns import DAY, HOUR
from loadlake.operators.blocks import block_window, numbered, own_rows, with_blocks

ENCODER_HOURS = 168
LABEL_DELAY_HOURS = 24


def time_index(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "event_ts_utc") -> DataFrame:
    """``time_idx``: position of the row in its series, from 0, over all splits."""
    return numbered(df, keys, ts, "time_idx", 90 * DAY)


def sequence_samples(
    df: DataFrame,
    features: Sequence[str],
    encoder_hours: int = ENCODER_HOURS,
    keys: Sequence[str] = ("series_id",),
    ts: str = "event_ts_utc",
    label: str = schemas.LABEL,
) -> DataFrame:
    """One sample per labelled row with a full encoder window.

    ``encoder`` holds the ``encoder_hours`` rows before the origin with their
    known features. ``label_history`` holds the labels among them that have
    become known: the label of hour h is the load of h + 24, so it ends 24
    hours before the origin. ``decoder`` holds the origin's own features.
    """
    before = encoder_hours * HOUR
    blocked = with_blocks(df, ts, 4 * before, before)
    w = block_window(keys, ts)
    step = F.struct(ts, *features)
    known_label = F.struct(F.col(ts), F.col(label).alias("label"))
    samples = blocked.select(
        "*",
        F.collect_list(step).over(w.rangeBetween(-before, -1)).alias("encoder"),
        F.collect_list(known_label).over(w.rangeBetween(-before, -LABEL_DELAY_HOURS * HOUR)).alias("label_history"),
    )
    return (
        own_rows(samples)
        .where((F.size("encoder") == encoder_hours) & F.col(label).isNotNull())
        .select(*keys, ts, "encoder", "label_history", F.struct(*features).alias("decoder"), F.col(label).alias("label"))
    )


def numeric_features(df: DataFrame, drop: Sequence[str] = (schemas.LABEL, "event_ts_utc", "dt", "series_id")) -> list[str]:
    """Numeric columns that are neither label nor metadata; booleans are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def feature_contract(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "event_ts_utc") -> DataFrame:
    """Exactly the contract's fields in their stored types."""
    return df.select(*keys, ts, *[F.col(name).cast(kind).alias(name) for name, kind in schemas.FEATURE_CONTRACT.items()])
