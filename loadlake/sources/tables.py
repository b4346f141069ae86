"""Day-partitioned lake tables and keyed result tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.functions.timefns import as_date
from loadlake.session import shared_dir


class EmptyTableError(RuntimeError):
    """A read or write that must not be empty was."""


def read_days(
    spark: SparkSession,
    root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    columns: Sequence[str] | None = None,
    day: str = "dt",
) -> DataFrame:
    """Partitions of the closed day range; ``columns`` are required, an absent one fails at once."""
    df = spark.read.parquet(root)
    if start is not None:
        df = df.where(F.col(day) >= as_date(start))
    if end is not None:
        df = df.where(F.col(day) <= as_date(end))
    return df if columns is None else df.select(*columns)


def read_many(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Bag union of several tables with the same columns."""
    first, *rest = [spark.read.parquet(r) for r in roots]
    for other in rest:
        first = first.unionByName(other)
    return first


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyTableError(f"no rows: {what}")
    return df


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh shared table and read back, for frames that several branches use."""
    root = shared_dir(df.sparkSession, purpose)
    df.write.parquet(root)
    return df.sparkSession.read.schema(df.schema).parquet(root)


def write_partitions(df: DataFrame, root: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; others stay.

    Rows are brought together by partition first. Small partitions become one
    file; a large one is split over several tasks.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(root)
    )


def write_days(df: DataFrame, root: str, day: str = "dt") -> None:
    """Replace the days present in ``df``; other days stay."""
    write_partitions(df, root, [day])


#: Up to so many partitions a condition lists their values; beyond it gives their range.
LISTED_PARTITIONS = 1000


def touched_partitions(df: DataFrame, partition_by: Sequence[str]) -> Column:
    """A condition of literals that holds for the partitions of ``df``, so a scan lists no other folders.

    For each partition column it names the values, or their range if there are
    more than ``LISTED_PARTITIONS``.
    """
    condition = F.lit(True)
    for column in partition_by:
        values = [r[0] for r in df.select(column).distinct().limit(LISTED_PARTITIONS + 1).collect()]
        if len(values) > LISTED_PARTITIONS:
            ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
            condition = condition & F.col(column).between(F.lit(ends["a"]), F.lit(ends["b"]))
        else:
            condition = condition & F.col(column).isin(values)
    return condition


def upsert(
    df: DataFrame, root: str, keys: Sequence[str], partition_by: Sequence[str], newest: str | None = None
) -> None:
    """Write rows by key: a row of ``df`` replaces the stored row of the same key.

    With ``newest`` it only does so if it is larger in that column or equal; a
    late arrival leaves the stored row as it is. Only partitions present in
    ``df`` are read and rewritten, so a rerun changes nothing. ``partition_by``
    must be part of ``keys``, and ``keys`` must be unique and not NULL in ``df``.
    """
    merged = df = stored(df, "upserts")
    table = stored_table(df.sparkSession, root, df.schema)
    if table is not None:
        table = table.where(touched_partitions(df, partition_by))
        if newest is None:
            merged = df.unionByName(table.join(df.select(*keys), list(keys), "left_anti"))
        else:
            both = df.withColumn("_new", F.lit(1)).unionByName(table.withColumn("_new", F.lit(0)))
            best = F.max_by(F.struct(*df.columns), F.struct(newest, "_new")).alias("_row")
            merged = both.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(best).select("_row.*")
    write_partitions(merged, root, partition_by)


def append(df: DataFrame, root: str, partition_by: Sequence[str]) -> None:
    """Plain append; a rerun adds the rows again. Rows are brought together by partition first."""
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(root)


def stored_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``root``, or None before its first write."""
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def lookback(table: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """Rows of a result table in a closed date range, newest first, through SQL with bound parameters."""
    return table.sparkSession.sql(
        "SELECT * FROM {table} WHERE {day} BETWEEN :start AND :end ORDER BY {day} DESC",
        args={"start": start, "end": end},
        table=table,
        day=F.col(day),
    )


def read_jdbc(
    spark: SparkSession, url: str, table: str, day: str, start: date, end: date, properties: dict[str, str] | None = None
) -> DataFrame:
    """A database result table over a closed date range, one partition per day."""
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    predicates = [f"{day} = DATE '{d.isoformat()}'" for d in days]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table; it is created on first use."""
    df.write.jdbc(url, table, mode="append", properties=properties or {})
