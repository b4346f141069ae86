"""Names, callables and oracle SQL of the catalogue."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.catalog.frames import Frames
from loadlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
Build = Callable[[Frames], DataFrame]

_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as plain SQL engines hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``, with its oracle if SQL can express it."""

    def register(build: Build) -> Build:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive_times(build(Frames(use_utc(spark), sf_dir)))

        _queries[name] = run
        if sql is not None:
            _oracle[name] = sql
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)
