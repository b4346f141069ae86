"""Landed JSON documents: scans, flattening, and the sink that writes them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.functions.calendar import day_columns
from loadlake.functions.points import index_timestamps, point_list
from loadlake.functions.timefns import day_bounds, day_start_millis, from_millis, iso_date, parse_timestamp
from loadlake.operators.asof import asof_join
from loadlake.operators.blocks import same_keys

# A document holds about this many points; a larger day is split over several.
POINTS_PER_DOCUMENT = 10_000


# Documents of a day land on it or within so many days after.
LANDING_DAYS = 7


def landed(documents: DataFrame, start: date | str | None, end: date | str | None, late_days: int) -> DataFrame:
    """Documents whose ``ingestion_date`` folder can hold points of the closed day range; the others are not listed."""
    if start is not None:
        documents = documents.where(F.col("ingestion_date") >= F.lit(iso_date(start) - timedelta(days=1)))
    if end is not None:
        documents = documents.where(F.col("ingestion_date") <= F.lit(iso_date(end) + timedelta(days=late_days)))
    return documents


def read_demand(
    spark: SparkSession,
    path: str | list[str],
    start: date | str | None = None,
    end: date | str | None = None,
    late_days: int = LANDING_DAYS,
) -> DataFrame:
    """Demand documents. With a day range ``path`` is a folder of ``ingestion_date=`` folders, and only those
    from the day before the range to ``late_days`` after it are read."""
    if start is None and end is None:
        return spark.read.schema(schemas.BRONZE_DEMAND).json(path)
    documents = spark.read.schema(f"{schemas.BRONZE_DEMAND}, ingestion_date DATE").json(path)
    return landed(documents, start, end, late_days)


def read_weather(
    spark: SparkSession,
    root: str,
    glob: str = "*/*/*.json",
    start: date | str | None = None,
    end: date | str | None = None,
    late_days: int = LANDING_DAYS,
) -> DataFrame:
    """All locations below ``root``; ``location=`` and ``ingestion_date=`` folders become columns, and with a day
    range only the folders that can hold it are read (see ``read_demand``)."""
    schema = schemas.BRONZE_WEATHER
    if start is not None or end is not None:
        schema = f"{schema}, ingestion_date DATE"
    documents = spark.read.schema(schema).option("basePath", root).json(f"{root.rstrip('/')}/{glob}")
    return landed(documents, start, end, late_days)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    """Calendar rows of the first document, by file name, of each ingestion date."""
    documents = spark.read.schema(f"{schemas.BRONZE_CALENDAR}, ingestion_date DATE").option("basePath", root).json(root)
    first = documents.groupBy("ingestion_date").agg(F.min_by("data", F.col("_metadata.file_path")).alias("data"))
    return first.select("ingestion_date", F.inline("data"))


def demand_points(documents: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """One row per point of the closed day range; points without a time are dropped."""
    points = documents.select("metadata", F.explode_outer("data").alias("p")).where(F.col("p.ts_ms").isNotNull())
    if start is not None:
        points = points.where(F.col("p.ts_ms") >= day_start_millis(start))
    if end is not None:
        points = points.where(F.col("p.ts_ms") < day_start_millis(end) + 86_400_000)
    ts = from_millis(F.col("p.ts_ms"))
    return points.select(
        *[F.coalesce(F.col(f"metadata.{c}"), F.lit(d)).alias(c) for c, d in schemas.SERIES_DEFAULTS.items()],
        parse_timestamp(F.col("metadata.ingested_at_utc")).alias("ingested_at_utc"),
        ts.alias("event_ts_utc"),
        F.to_date(ts).alias("dt"),
        F.col("p.load_mw").alias("load_mw"),
    )


def weather_hours(documents: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """One row per entry of ``raw.hourly.time``, with each document's own location.

    A variable array shorter than ``time`` gives NULL at the end, and so does
    a time that cannot be read, whose row is then dropped.
    """
    parsed = documents.select("metadata", F.from_json(F.col("raw")["hourly"], schemas.WEATHER_HOURLY).alias("h"))
    flat = parsed.select("metadata", "h.*")
    hours = flat.select(
        "metadata", *schemas.WEATHER_VARIABLES, F.posexplode("time").alias("idx", "time_str")
    ).select(
        parse_timestamp(F.col("time_str")).alias("event_ts_utc"),
        F.col("metadata.location_name").alias("location_name"),
        F.col("metadata.latitude").alias("latitude"),
        F.col("metadata.longitude").alias("longitude"),
        *[F.get(v, F.col("idx")).alias(v) for v in schemas.WEATHER_VARIABLES],
    )
    hours = hours.withColumn("dt", F.to_date("event_ts_utc")).where(F.col("dt").isNotNull())
    if start is not None:
        hours = hours.where(F.col("dt") >= F.lit(start).cast("date"))
    if end is not None:
        hours = hours.where(F.col("dt") <= F.lit(end).cast("date"))
    return hours


def calendar_documents(days: DataFrame, generated_at: Column, holidays: DataFrame | None = None) -> DataFrame:
    """The derived calendar document of each ``dt`` of ``days``."""
    day = F.col("dt").cast("date")
    is_holiday = None
    if holidays is not None:
        marked = holidays.select(F.col("dt").cast("date").alias("dt")).distinct().withColumn("_holiday", F.lit(True))
        days, is_holiday = days.join(marked, "dt", "left"), F.col("_holiday")
    row = F.struct(
        F.date_format(day, "yyyy-MM-dd").alias("dt"),
        *[c.alias(name) for name, c in day_columns(day, is_holiday).items()],
    )
    metadata = F.struct(
        F.date_format(day, "yyyy-MM-dd").alias("run_date"),
        F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at_utc"),
        F.lit("derived-calendar").alias("source"),
        F.lit("UTC").alias("timezone"),
        F.lit("germany").alias("scope"),
    )
    return days.select(day.alias("ingestion_date"), metadata.alias("metadata"), F.array(row).alias("data"))


def demand_documents(
    points: DataFrame,
    series: Sequence[str] = schemas.SERIES_COLUMNS,
    ts: str = "event_ts_utc",
    value: str = "load_mw",
    points_per_document: int = POINTS_PER_DOCUMENT,
) -> DataFrame:
    """Nest points as documents of one (series, day).

    A day with more points than a document takes is spread over as many
    documents as it needs, so no task holds a whole large day. The share a
    point falls into mixes in its input partition, which also spreads equal
    points.
    """
    day = F.to_date(F.col(ts))
    spread = points.select(
        *series,
        day.alias("ingestion_date"),
        F.struct(F.unix_millis(ts).alias("ts_ms"), F.col(value).alias("load_mw")).alias("point"),
        F.xxhash64(ts, value, F.spark_partition_id()).alias("_share"),
    )
    sizes = points.groupBy(*series, day.alias("ingestion_date")).agg(
        F.ceil(F.count(F.lit(1)) / points_per_document).alias("_parts")
    )
    nested = (
        spread.alias("l")
        .join(sizes.alias("r"), same_keys("l", "r", [*series, "ingestion_date"]))
        .select("l.*", "r._parts")
        .groupBy(*series, "ingestion_date", F.expr("pmod(_share, _parts)").alias("part"))
        .agg(F.array_sort(F.collect_list("point")).alias("data"))
    )
    metadata = F.struct(
        *[F.col(c) for c in series],
        F.unix_millis(F.to_timestamp("ingestion_date")).alias("chunk_timestamp_ms"),
        F.date_format("ingestion_date", "yyyy-MM-dd").alias("run_date"),
    )
    return nested.select("ingestion_date", metadata.alias("metadata"), "data")


def weather_documents(hours: DataFrame, variables: Sequence[str] = schemas.WEATHER_VARIABLES) -> DataFrame:
    """Nest hourly weather as one document of parallel arrays per (location, day), at most 24 entries each."""
    entry = F.struct(
        F.date_format("event_ts_utc", "yyyy-MM-dd'T'HH:mm").alias("time"), *[F.col(v) for v in variables]
    )
    nested = hours.groupBy("location_name", "latitude", "longitude", F.to_date("event_ts_utc").alias("ingestion_date")).agg(
        F.array_sort(F.collect_list(entry)).alias("_hours")
    )
    hourly = F.struct(*[F.col(f"_hours.{c}").alias(c) for c in ("time", *variables)])
    metadata = F.struct(
        F.lit("open-meteo").alias("source"),
        "location_name",
        "latitude",
        "longitude",
        F.date_format("ingestion_date", "yyyy-MM-dd").alias("run_date"),
        F.lit("UTC").alias("timezone"),
        F.array(*[F.lit(v) for v in variables]).alias("hourly_vars"),
    )
    return nested.select(
        F.col("location_name").alias("location"),
        "ingestion_date",
        metadata.alias("metadata"),
        F.struct(hourly.alias("hourly")).alias("raw"),
    )


def write_documents(documents: DataFrame, root: str, partition_by: Sequence[str] = ("ingestion_date",)) -> None:
    """Replace the partitions present in ``documents``; others stay. Small ones become one file each."""
    (
        documents.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .json(root)
    )


def chunk_envelopes(chunks: DataFrame, text: str, day: str, ingested_at: Column) -> DataFrame:
    """Landed documents of source chunks: the points of ``day``, described and beside the raw chunk.

    ``chunks`` has the series columns, ``chunk_ts_ms``, the day to cut out and
    the chunk's JSON text, one row per document.
    """
    start, end = (F.unix_millis(t) for t in day_bounds(F.col(day)))
    raw = F.from_json(text, "map<string,string>")
    metadata = F.struct(
        F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ingested_at_utc"),
        *schemas.SERIES_COLUMNS,
        F.col("chunk_ts_ms").alias("chunk_timestamp_ms"),
        F.date_format(day, "yyyy-MM-dd").alias("run_date"),
    )
    return chunks.select(
        F.col(day).alias("ingestion_date"),
        metadata.alias("metadata"),
        F.filter(point_list(raw), lambda p: (p["ts_ms"] >= start) & (p["ts_ms"] < end)).alias("data"),
        raw.alias("raw"),
    )


def read_chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw source chunks, one JSON object per line, as points with the file they came from."""
    lines = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("chunk"))
    return lines.select(F.inline(point_list(F.col("chunk"))))


def chunk_points(chunks: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Points of chunks held in a text column."""
    return chunks.select(*keep, F.from_json(text, "map<string,string>").alias("_chunk")).select(
        *keep, F.inline(point_list(F.col("_chunk")))
    )


def index_points(indexes: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row ``chunk_ts_ms`` per chunk start listed in an index file held in a text column."""
    return indexes.select(*keep, F.explode(index_timestamps(F.col(text))).alias("chunk_ts_ms"))


def pick_chunk(index: DataFrame, day: date | str, ts_ms: str = "chunk_ts_ms") -> DataFrame:
    """The chunk holding ``day``: the latest start not after it, else the earliest start."""
    at = day_start_millis(day)
    held = F.max(F.when(F.col(ts_ms) <= at, F.col(ts_ms)))
    return index.agg(F.coalesce(held, F.min(ts_ms)).alias("chunk_ts_ms"))


def pick_chunks(index: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``pick_chunk`` for every (keys, dt) of ``days``."""
    starts = index.select(*keys, "chunk_ts_ms", from_millis(F.col("chunk_ts_ms")).alias("_start")).distinct()
    asked = days.select(*keys, "dt", F.to_timestamp("dt").alias("_day"))
    earliest = index.groupBy(*keys).agg(F.min("chunk_ts_ms").alias("_earliest"))
    held = asof_join(asked, starts, keys, "_day", "_start", block_seconds=366 * 86_400)
    return held.join(earliest, list(keys), "left").select(
        *keys, "dt", F.coalesce("chunk_ts_ms", "_earliest").alias("chunk_ts_ms")
    )
